"""Orders with their lines nested, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bayline.operators.joins import spread_lookup
from bayline.session import stage


def nest_lines(
    lines: DataFrame, keys: Sequence[str], item: Sequence[str], spread_on: Sequence[Column],
    max_lines: int = 10_000,
) -> DataFrame:
    """One row per order with its lines as an array of structs, in line order.

    An order of more than about `max_lines` lines is stored as several rows numbered by
    `part_no`, because one row (and the task that builds it) cannot hold an unbounded array. No
    line is left out; `unnest_lines` returns them all.
    """
    # Sizes come from a combinable count. Only oversized orders are stored and looked up.
    parts = F.ceil(F.col("_n") / F.lit(max_lines)).cast("int")
    oversized = stage(
        lines.groupBy(*keys).agg(F.count("*").alias("_n"))
        .where(F.col("_n") > max_lines).withColumn("_parts", parts),
        "oversized",
    )
    split = spread_lookup(
        lines, oversized, keys, "_n", ["_parts"], spread_on
    ).withColumn(
        "part_no",
        F.coalesce(F.pmod(F.xxhash64(*spread_on), F.col("_parts")).cast("int"), F.lit(0)),
    )
    return split.groupBy(*keys, "part_no").agg(
        F.sort_array(F.collect_list(F.struct(*item))).alias("line_items")
    )


def unnest_lines(nested: DataFrame, keys: Sequence[str]) -> DataFrame:
    return nested.select(*keys, F.inline("line_items"))
