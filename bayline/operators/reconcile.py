"""Comparison of two versions of a data set, and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def reconcile(
    old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Long-form report: row counts, column sums, keys on one side only, differing fields.

    Both sides are stacked and grouped by key, which is one combinable shuffle; a join would
    build every pair of a repeated key. Fields are compared for keys that occur once on each
    side; other shared keys are reported as `repeated_keys`.
    """
    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.col(key), *columns, F.lit(side).alias("_side"))

    is_old, is_new = F.col("_side") == 0, F.col("_side") == 1
    aggs = [F.count_if(is_old).alias("_n_old"), F.count_if(is_new).alias("_n_new")]
    for c in columns:
        aggs += [F.max(F.when(is_old, F.col(c))).alias(f"_o_{c}"),
                 F.max(F.when(is_new, F.col(c))).alias(f"_n_{c}")]
    for c in sums:
        aggs += [F.sum(F.when(is_old, F.col(c))).alias(f"_so_{c}"),
                 F.sum(F.when(is_new, F.col(c))).alias(f"_sn_{c}")]
    per_key = tagged(old, 0).unionByName(tagged(new, 1)).groupBy(key).agg(*aggs)

    once = (F.col("_n_old") == 1) & (F.col("_n_new") == 1)
    on_both = (F.col("_n_old") > 0) & (F.col("_n_new") > 0)
    none = F.lit(0.0)

    def total(col) -> F.Column:
        return F.coalesce(F.sum(col).cast("double"), none)

    rows = [
        ("rows", "*", total(F.col("_n_old")), total(F.col("_n_new"))),
        *[("sum", c, total(F.col(f"_so_{c}")), total(F.col(f"_sn_{c}"))) for c in sums],
        ("keys_on_one_side", key, F.count_if(F.col("_n_new") == 0).cast("double"),
         F.count_if(F.col("_n_old") == 0).cast("double")),
        ("repeated_keys", key, F.count_if(on_both & ~once).cast("double"), none),
        *[("differing_fields", c,
           F.count_if(once & ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))).cast("double"),
           none)
          for c in columns],
    ]
    return per_key.agg(F.array(*[
        F.struct(F.lit(kind).alias("measure"), F.lit(col).alias("column_name"),
                 a.alias("old_value"), b.alias("new_value"))
        for kind, col, a, b in rows
    ]).alias("rows")).select(F.inline("rows"))


def differing_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows one side has more often than the other, tagged with the side.

    Both sides are stacked and counted once, +1 and -1; what is left over is repeated.
    """
    weighed = old.withColumn("_n", F.lit(1)).unionByName(new.withColumn("_n", F.lit(-1)))
    left = weighed.groupBy(*old.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return left.withColumn("side", F.when(F.col("_n") > 0, "old").otherwise("new")).withColumn(
        "_n", F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int")))).drop("_n")


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest value as text.

    Min, max and null counts are one narrow pass. Exact distinct counts are taken from
    (column, value) pairs combined per map task; `approximate` uses sketches instead and keeps
    the whole profile in that one pass.
    """
    columns = df.columns
    stats = []
    for c in columns:
        entry = [
            F.lit(c).alias("column_name"), F.count("*").alias("row_count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value"),
        ]
        if approximate:
            entry.append(F.approx_count_distinct(c).alias("distinct_count"))
        stats.append(F.struct(*entry))
    base = df.agg(F.array(*stats).alias("rows")).select(F.inline("rows"))
    if approximate:
        return base
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])).alias("p")).select("p.*").where(F.col("value").isNotNull())
    distinct = pairs.distinct().groupBy("column_name").agg(
        F.count("*").alias("distinct_count"))
    return base.join(distinct, "column_name", "left").select(
        *base.columns, F.coalesce("distinct_count", F.lit(0)).alias("distinct_count")
    )
