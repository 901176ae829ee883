"""Partitioned, sorted storage of facts and marts, and guarded access to it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from bayline.operators.commits import Commits


def write_partitioned(
    df: DataFrame, path: str, partition: str, cluster: Sequence[str], spread_on: str | None = None,
    mode: str = "overwrite", files: int | None = None,
) -> None:
    """Write one folder per partition value, files sorted by the cluster columns.

    Range partitioning on (partition, cluster..., spread) gives every task a contiguous slice:
    few files per folder, narrow min/max ranges per file for row-group skipping, and a hot month
    is cut over several tasks instead of being written by one.
    """
    order = [F.col(partition), *[F.col(c) for c in cluster]]
    ranges = order + ([F.xxhash64(spread_on)] if spread_on else [])
    sliced = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    sliced.sortWithinPartitions(*order).write.mode(mode).partitionBy(partition).parquet(path)


def create_table_as(df: DataFrame, name: str, path: str, partition: str | None = None) -> DataFrame:
    """Store a frame as a catalog table at `path` and return the table."""
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if partition:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def read_between(
    spark: SparkSession, path: str, partition: str, start, end
) -> DataFrame:
    """Rows of a partition range. Both bounds are required: there is no full-scan default."""
    if start is None or end is None:
        raise ValueError(f"a range on {partition} is required to read {path}")
    return spark.read.parquet(path).where(
        F.col(partition).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )


def range_bucket(key, start: int, end: int, step: int):
    """0-based bucket of an integer key in [start, end); NULL outside."""
    inside = (key >= start) & (key < end)
    return F.when(inside, F.floor((key - start) / step).cast("int"))


def expire_partitions(df: DataFrame, partition: str, as_of, keep_days: int = 2555) -> DataFrame:
    """Rows young enough to keep; a filter on the partition column, so old folders are skipped."""
    return df.where(F.col(partition) >= F.date_sub(F.lit(as_of).cast("date"), keep_days))


def publish(tables: Mapping[str, DataFrame], root: str) -> int:
    """Full refresh: write a new version beside the old one and commit it under the next number.

    Readers see either the complete old version or the complete new one.
    """
    return Commits(root).commit(tables)


def open_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest commit."""
    return Commits(root).open(spark, name)


def write_report(df: DataFrame, path: str) -> None:
    """Small result tables as one JSON file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
