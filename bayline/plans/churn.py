"""Churn model: stratified split, boosted trees, scores, drivers and held-out metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from bayline.operators.ranking import with_group_position
from bayline.plans import metrics
from bayline.schemas import FEATURES
from bayline.session import scratch_root, stage

KEY, LABEL = "customer_key", "churned"


@dataclass(frozen=True)
class Settings:
    # Fixed values of the model.
    trees: int = 250
    depth: int = 3
    rate: float = 0.06
    seed: int = 42
    test_fraction: float = 0.25


def training_frame(labelled: DataFrame) -> DataFrame:
    """Features as doubles and the label: churned is the opposite of retained."""
    return labelled.select(
        KEY, "region", *[F.col(f).cast("double").alias(f) for f in FEATURES],
        (1 - F.col("retained_next_period").cast("int")).alias(LABEL),
    )


def stratified_split(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add `is_train`: each class gives exactly its share of rows to the test set.

    Rows are ordered by class and the md5 of seed and key, so the split depends neither on row
    order nor on partitioning nor on the engine, and no class is sorted in one task.
    """
    order = [F.md5(F.concat_ws(":", F.lit(settings.seed), F.col(KEY))), F.col(KEY)]
    held_out = F.round(F.col("group_rows") * F.lit(settings.test_fraction))
    return with_group_position(df, LABEL, order).select(
        *df.columns, (F.col("group_position") >= held_out).cast("int").alias("is_train"))


def fit(train: DataFrame, settings: Settings = Settings()) -> PipelineModel:
    """Gradient-boosted trees; missing averages (customers nobody surveyed) get the mean."""
    context = train.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(train.sparkSession))
    filled = [f"_{f}" for f in FEATURES]
    return Pipeline(stages=[
        Imputer(inputCols=list(FEATURES), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="_features"),
        GBTClassifier(
            featuresCol="_features", labelCol=LABEL,
            maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.rate,
            seed=settings.seed, checkpointInterval=10,
        ),
    ]).fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Churn risk per row, joined to nothing: the key travels through the model."""
    risk = vector_to_array(F.col("probability"))[1]
    return model.transform(df).select(*df.columns, risk.alias("churn_risk"))


def drivers(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature importances rounded to four digits, highest first; one row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(f, round(float(w), 4)) for f, w in zip(FEATURES, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def held_out_metrics(scored: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """AUC, average precision and lift of the top tenth on the test rows."""
    test = stage(
        scored.where(F.col("is_train") == 0).select(KEY, "churn_risk", LABEL), "held-out")
    curve = metrics.curve_metrics(metrics.score_curve(test, "churn_risk", LABEL))
    lift = metrics.lift_at(test, "churn_risk", LABEL, KEY).select("lift").scalar()
    return curve.select(
        F.round("roc_auc", 4).alias("churn_roc_auc"),
        F.round("average_precision", 4).alias("churn_pr_auc"),
        F.round(lift, 2).alias("lift_at_10pct"),
    )


@dataclass(frozen=True)
class ChurnRun:
    split: DataFrame
    model: PipelineModel
    scored: DataFrame


def run(labelled: DataFrame, settings: Settings = Settings()) -> ChurnRun:
    """Split, train on the training rows, score everybody (`is_train` tells them apart)."""
    split = stratified_split(training_frame(labelled), settings)
    model = fit(split.where(F.col("is_train") == 1), settings)
    return ChurnRun(split, model, score(model, split))
