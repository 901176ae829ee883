"""What a filter has to read: zone maps of stored tables, and a space-filling order for them.

A zone map has a row for each row group and column of a table's Parquet files: the smallest and the
largest value, rows and bytes, as the files' footers tell them. They are read in tasks, a footer at
a time. `touched` tells from it which row groups a filter can't skip. A table sorted along a
space-filling curve keeps rows near in several columns together, so that filters on any of them skip
most row groups, not only filters on the first sort column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BITS = 10
# Distinct texts that are told apart in order; more are told apart by a hash.
MOST_TEXTS = 1 << BITS

ZONES = ("file string, row_group int, column_name string, low string, high string, is_number boolean, "
         "row_count long, bytes long")


def _codes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column's value as a number below 2**BITS that keeps the order. NULL counts as lowest."""
    numeric = [c for c in columns if not isinstance(df.schema[c].dataType, T.StringType)]

    def number(c: str) -> Column:
        kind = df.schema[c].dataType
        return (F.datediff(F.col(c), F.lit("1970-01-01")) if isinstance(kind, T.DateType) else F.col(c)).cast("double")

    ends = df.agg(F.lit(0).alias("_"), *[f(number(c)).alias(f"{n}_{c}") for c in numeric for n, f in (("low", F.min), ("high", F.max))]).first()
    codes = []
    for c in columns:
        if c in numeric:
            low, high = ends[f"low_{c}"] or 0.0, ends[f"high_{c}"] or 0.0
            width = (high - low) or 1.0
            code = F.floor((number(c) - low) / width * ((1 << BITS) - 1))
        else:
            texts = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).limit(MOST_TEXTS + 1).collect()]
            if len(texts) > MOST_TEXTS:
                code = F.pmod(F.xxhash64(c), F.lit(1 << BITS))
            else:
                step = max(1, ((1 << BITS) - 1) // max(1, len(texts)))
                code = F.array_position(F.array(*[F.lit(t) for t in texts] or [F.lit("")]), F.col(c)) * step
        codes.append(F.coalesce(code, F.lit(0)).cast("long"))
    return codes


def curve(codes: Sequence[Column], bits: int = BITS) -> Column:
    """The place on a Z-shaped curve: the codes' bits in turn, the highest first."""
    parts = [
        F.shiftleft(F.shiftright(code, i).bitwiseAND(F.lit(1)), i * len(codes) + d)
        for i in range(bits) for d, code in enumerate(codes)]
    return reduce(Column.bitwiseOR, parts)


def write_curve(df: DataFrame, path: str, columns: Sequence[str], files: int, group_bytes: int | None = None) -> None:
    """Store a table in the order of the curve over the columns, in about so many files."""
    placed = df.withColumn("_place", curve(_codes(df, columns)))
    writer = placed.repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place").write
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)


def zone_map(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The zones of a stored table, from its files' footers. Partition columns have none."""
    wanted = set(columns)

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for uri in batch["file"]:
                files, name = fs.FileSystem.from_uri(uri)
                with files.open_input_file(name) as source:
                    footer = pq.ParquetFile(source).metadata
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    for i in range(group.num_columns):
                        column = group.column(i)
                        if column.path_in_schema not in wanted:
                            continue
                        known = column.is_stats_set and column.statistics.has_min_max
                        ends = (column.statistics.min, column.statistics.max) if known else (None, None)
                        rows.append((uri, g, column.path_in_schema, *(None if v is None else str(v) for v in ends),
                                     isinstance(ends[0], (int, float)), group.num_rows, group.total_byte_size))
            yield pd.DataFrame(rows, columns=["file", "row_group", "column_name", "low", "high", "is_number", "row_count", "bytes"])

    # The names that a scan of the table lists anyway.
    files = [(f,) for f in spark.read.parquet(path).inputFiles()]
    listed = spark.createDataFrame(files, "file string")
    return listed.repartition(max(1, min(len(files), 1000)), "file").mapInPandas(footers, ZONES)


def touched(zones: DataFrame, wanted: dict[str, tuple[Any, Any]]) -> DataFrame:
    """Row groups, rows and bytes that a filter (column -> smallest and largest value) has to read.

    A zone without known ends can't be skipped.
    """
    def beyond(name: str, value: Any, above: bool) -> Column:
        if isinstance(value, (int, float)):
            told, limit = F.col(name).try_cast("double"), F.lit(float(value))
        else:
            told, limit = F.col(name), F.lit(str(value))
        return told > limit if above else told < limit

    misses = F.lit(False)
    for column, (low, high) in wanted.items():
        apart = F.coalesce(beyond("low", high, True) | beyond("high", low, False), F.lit(False))
        misses = misses | ((F.col("column_name") == column) & apart)
    groups = zones.groupBy("file", "row_group").agg(
        F.max(misses).alias("skipped"), F.first("row_count").alias("row_count"), F.first("bytes").alias("bytes"))
    left = F.when(~F.col("skipped"), 1)
    return groups.agg(
        F.count("*").alias("all_groups"), F.sum("bytes").alias("all_bytes"), F.count(left).alias("groups"),
        F.coalesce(F.sum(left * F.col("row_count")), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(left * F.col("bytes")), F.lit(0)).alias("bytes"))
