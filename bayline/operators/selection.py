"""The best-scored rows of a table without sorting it.

The last row that belongs to the best n is found by histograms of the score that narrow around it:
each pass counts the rows of equal steps between the bounds, in one aggregation with a row per step,
and goes on within the step where the count passes n. Once few rows are left between the bounds only
these are sorted. With that row known, the selection is a filter. Narrowing looks at two columns,
stored once; the table itself is neither shuffled nor written.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from bayline.operators.ranking import with_position
from bayline.session import stage

STEPS = 4096
FEW_ROWS = 200_000

# Kinds of score from best to worst; only finite scores are told apart by value.
_NAN, _INFINITE, _FINITE, _MINUS_INFINITE, _NULL = range(5)


def _kind(score: Column) -> Column:
    number = score.cast("double")
    return (
        F.when(score.isNull(), _NULL).when(F.isnan(number), _NAN).when(number == float("inf"), _INFINITE)
        .when(number == float("-inf"), _MINUS_INFINITE).otherwise(_FINITE)
    )


@dataclass(frozen=True)
class Cut:
    """The last row that is in; everything is in where `whole`."""

    score: Any = None
    key: Any = None
    whole: bool = False

    def holds(self, score: Column, key: Column) -> Column:
        """Is a row at or before the cut: better scores first, NULL last, ties by key?"""
        if self.whole:
            return F.lit(True)
        # A NULL key comes first.
        last = key.isNull() if self.key is None else F.coalesce(key <= F.lit(self.key), F.lit(True))
        if self.score is None:
            return score.isNotNull() | last
        limit = F.lit(self.score)
        return F.coalesce(score > limit, F.lit(False)) | (F.coalesce(score == limit, F.lit(False)) & last)


def _step(score: Column, low: float, high: float) -> Column:
    """0 for the best step. The bounds' own span is divided first, as it may overflow a double."""
    width = high / STEPS - low / STEPS
    if width == 0:  # bounds that lie next to each other or below the smallest numbers
        return F.when(score.cast("double") == high, 0).otherwise(1)
    part = F.lit(high / STEPS) - score.cast("double") / STEPS
    return F.least(F.floor(part / F.lit(width) * STEPS), F.lit(STEPS - 1)).cast("int")


def nth(rows: DataFrame, score: str, key: str, n: int, few: int = FEW_ROWS) -> Cut:
    """The n-th best row (from 1) of a stored frame by score descending and key; keys are unique.

    Each pass leaves at most one step between the bounds, unless equal scores fill it.
    """
    left = n
    classes = rows.withColumn("_kind", _kind(F.col(score)))
    found = {r["_kind"]: r for r in classes.groupBy("_kind").agg(
        F.count("*").alias("n"), F.min(score).alias("low"), F.max(score).alias("high")).collect()}
    kind = next(k for k in sorted(found) if (left := left - found[k]["n"]) <= 0)
    left += found[kind]["n"]
    some = classes.where(F.col("_kind") == kind).drop("_kind")
    low, high, size = found[kind]["low"], found[kind]["high"], found[kind]["n"]
    while kind == _FINITE and size > few and float(low) < float(high):
        between = some.where(F.col(score).between(F.lit(low), F.lit(high)))
        steps = between.groupBy(_step(F.col(score), float(low), float(high)).alias("step")).agg(
            F.count("*").alias("n"), F.min(score).alias("low"), F.max(score).alias("high")).collect()
        # A row for each step, STEPS at most.
        for step in sorted(steps, key=lambda r: r["step"]):
            if left <= step["n"]:
                break
            left -= step["n"]
        low, high, size = step["low"], step["high"], step["n"]
    if kind == _FINITE:
        some = some.where(F.col(score).between(F.lit(low), F.lit(high)))
    order = [F.desc(score), F.asc(key)]
    last = with_position(some.select(score, key), order).where(F.col("position") == left - 1).first()
    return Cut(last[score], last[key])


def best_fraction(
    df: DataFrame, fraction: float, score: str, key: str, at_least: int = 0, few: int = FEW_ROWS
) -> DataFrame:
    """The best-scored fraction of the rows, rounded down, exact in ties (smaller keys first)."""
    narrow = stage(df.select(score, key), "scores")
    rows = narrow.count()
    n = min(rows, max(at_least, int(rows * fraction)))
    if n == 0:
        return df.limit(0)
    cut = Cut(whole=True) if n == rows else nth(narrow, score, key, n, few)
    return df.where(cut.holds(F.col(score), F.col(key)))
