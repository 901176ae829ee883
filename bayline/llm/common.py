"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bayline.session import stage

# Rows handed to a Python worker at a time; texts may be long.
ARROW_ROWS = 512
ARROW_BYTES = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python workers, and let Spark split skewed join inputs."""
    for key, value in {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def worker_memo(spark: SparkSession):
    """A broadcast empty dict. A Python worker loads it once, so its tasks share what one of them
    puts there: a function's second call in the same worker finds it. It only saves work."""
    return spark.sparkContext.broadcast({})


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, however often the body names it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


__all__ = ["ARROW_ROWS", "let", "prepare", "remainder", "stage", "table", "worker_memo"]
