"""Exact ranking metrics of a score column against a 0/1 label."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bayline.operators.ranking import with_running_totals
from bayline.operators.selection import best_fraction
from bayline.session import stage


def score_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: positives, rows, and both summed over all lower scores.

    Equal scores are combined inside the map tasks first, so a score that a third of all rows
    share is one row by the time anything is sorted.
    """
    groups = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count("*").alias("n")
    )
    return with_running_totals(groups, [F.col("score")], ["pos", "n"])


def curve_metrics(curve: DataFrame) -> DataFrame:
    """ROC AUC (ties count half) and average precision from one pass over the curve."""
    positives, rows = curve.agg(F.sum("pos")).scalar(), curve.agg(F.sum("n")).scalar()
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    neg_below = F.col("n_before") - F.col("pos_before")
    # Walking down from the top: everything not ranked below this score is at or above it.
    precision = (F.col("p") - F.col("pos_before")) / (F.col("t") - F.col("n_before"))
    # Twice the number of (positive, negative) pairs ranked right, kept as an exact integer.
    wins = F.sum(pos.cast("decimal(19,0)") * (2 * neg_below + neg).cast("decimal(19,0)"))
    summed = curve.withColumns({"p": positives, "t": rows}).agg(
        wins.cast("double").alias("wins"), F.sum(pos * precision).alias("precision_sum"),
        F.max("p").cast("double").alias("p"), F.max("t").cast("double").alias("t"),
    )
    pairs = 2 * F.col("p") * (F.col("t") - F.col("p"))
    return summed.select(
        F.round(F.try_divide("wins", pairs), 6).alias("roc_auc"),
        F.round(F.try_divide("precision_sum", "p"), 6).alias("average_precision"),
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    return curve_metrics(score_curve(df, score, label)).select("roc_auc")


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    return curve_metrics(score_curve(df, score, label)).select("average_precision")


def lift_at(df: DataFrame, score: str, label: str, key: str, fraction: float = 0.1) -> DataFrame:
    """Label mean among the best-scored fraction (at least one row) over the overall mean."""
    rows = stage(df.select(score, key, label), "scored")
    hit = F.col(label).cast("bigint")
    top = best_fraction(rows, fraction, score, key, at_least=1).agg(
        F.count("*").alias("targeted"), F.sum(hit).cast("double").alias("pos_top"))
    whole = {"pos_all": F.sum(hit).cast("double"), "n_all": F.count("*").cast("double")}
    counted = top.withColumns({name: rows.agg(total).scalar() for name, total in whole.items()})
    return counted.select(
        "targeted",
        F.round(F.try_divide(
            F.try_divide(F.col("pos_top"), F.col("targeted").cast("double")),
            F.try_divide(F.col("pos_all"), F.col("n_all"))), 6).alias("lift"),
    )
