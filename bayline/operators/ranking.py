"""Global positions and running totals without a single-task sort.

An unpartitioned window would move a whole table into one task. Instead the rows are range
partitioned on a unique order, each partition numbers its own rows, and the (few) partition sizes
are turned into offsets. The numbered rows are staged before the offsets are computed, because
both steps must see the same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bayline.session import COMPACT, stage

_LOCAL_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def _offsets(staged: DataFrame, part: str, totals: Sequence[Column], names: Sequence[str]):
    """Per partition, the totals of all partitions before it. One row per partition."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    per_part = staged.groupBy(part).agg(*[t.alias(n) for t, n in zip(totals, names)])
    return per_part.select(
        part, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in names]
    )


def with_position(
    df: DataFrame, order: Sequence[Column], name: str = "position", keep: Sequence[str] | None = None
) -> DataFrame:
    """Add the 0-based global position of each row under `order`, which must be unique.

    A unique order also means that equal leading values (a hot score, say) are split over
    several partitions by the columns behind them. Columns outside `keep` (None: all) are sorted by
    only, not stored.
    """
    staged = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _LOCAL_BITS))
        .withColumn("_local", F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .select(*(df.columns if keep is None else keep), "_part", "_local"),
        "position", COMPACT,
    )
    offsets = _offsets(staged, "_part", [F.count("*")], ["_offset"])
    # The offsets have one row per shuffle partition, so broadcasting them is always safe.
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_part", "_local", "_offset")
    )


def with_running_totals(
    df: DataFrame, order: Sequence[Column], columns: Sequence[str], suffix: str = "_before"
) -> DataFrame:
    """Add, per column, the sum over all rows ordered before this one (`order` unique)."""
    staged = stage(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "running"
    )
    starts = [f"_start_{c}" for c in columns]
    offsets = _offsets(staged, "_part", [F.sum(c) for c in columns], starts)
    local = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return staged.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        *[
            (F.col(s) + F.coalesce(F.sum(c).over(local), F.lit(0))).alias(f"{c}{suffix}")
            for c, s in zip(columns, starts)
        ],
    )


def with_surrogate_key(
    df: DataFrame, order: Sequence[Column], name: str, start: int = 1, keep: Sequence[str] | None = None
) -> DataFrame:
    """Consecutive keys in the given (unique) order, first column of the result; then `keep`, or all columns."""
    ranked = with_position(df, order, "_pos", keep)
    return ranked.select((F.col("_pos") + start).alias(name), *(df.columns if keep is None else keep))


def fraction_rows(fraction: float, at_least: int = 0) -> Column:
    """Aggregate: how many rows the given fraction of a frame is, rounded down."""
    return F.greatest(
        F.lit(at_least).cast("bigint"), F.floor(F.count("*") * F.lit(float(fraction)))
    )


def top_fraction(
    df: DataFrame, order: Sequence[Column], fraction: float, at_least: int = 0
) -> DataFrame:
    """The first rows under a unique order, as many as the fraction of all rows."""
    ranked = with_position(df, order, "_pos")
    rows = ranked.agg(fraction_rows(fraction, at_least)).scalar()
    return ranked.where(F.col("_pos") < rows).drop("_pos")


def with_group_position(df: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """Add `group_position` (0-based, under `order`) and `group_rows` per group.

    Works from global positions, so a group of any size is numbered by many tasks: its first
    position is a plain minimum over the group.
    """
    ranked = with_position(df, [F.col(group), *order], "_pos")
    groups = ranked.groupBy(group).agg(
        F.min("_pos").alias("_first"), F.count("*").alias("group_rows"))
    return ranked.join(groups, group).select(
        *df.columns, (F.col("_pos") - F.col("_first")).alias("group_position"), "group_rows")


def top_fraction_per_group(
    df: DataFrame, group: str, order: Sequence[Column], fraction: float
) -> DataFrame:
    """The first rows of each group, as many as the fraction of its rows, rounded down."""
    wanted = F.floor(F.col("group_rows") * F.lit(float(fraction)))
    return with_group_position(df, group, order).where(F.col("group_position") < wanted).drop(
        "group_position", "group_rows")


def top_n_per_group(
    df: DataFrame, group: str, order: Sequence[Column], spread_on: str, n: int, salts: int = 64
) -> DataFrame:
    """Exact top n per group in two cuts, so that a group is never sorted by one task whole.

    The first cut keeps n rows per (group, salt), the second n per group; the true top n always
    survives the first cut.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_on), F.lit(salts)))
    for keys in (["_salt", group], [group]):
        salted = salted.withColumn(
            "_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ).where(F.col("_nth") <= n)
    return salted.drop("_salt", "_nth")
