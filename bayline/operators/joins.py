"""Join helpers that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Rows of the heavy-key list. Any key outside the list owns at most 1/HEAVY_KEYS of the rows,
# and the list itself is small enough to broadcast whatever the size of the tables.
HEAVY_KEYS = 1000
_SALTS = 1 << 16


def spread_lookup(
    big: DataFrame, lookup: DataFrame, keys: Sequence[str], weight: str, values: Sequence[str],
    spread_on: Sequence[Column],
) -> DataFrame:
    """Left join of `big` to a lookup that is unique on `keys`, without hot partitions.

    `weight` is the number of `big` rows per key. The heaviest keys are answered from a bounded
    broadcast list; their rows then get a salt the lookup never carries, so the shuffle of the
    second join scatters them evenly instead of sending them all to one task. Every other row
    has salt 0 and meets its key there.
    """
    keys = list(keys)
    heavy = (
        lookup.orderBy(F.desc(weight), *keys).limit(HEAVY_KEYS)
        .select(*keys, F.struct(*values).alias("_heavy"))
    )
    marked = big.join(F.broadcast(heavy), keys, "left").withColumn(
        "_salt",
        F.when(F.col("_heavy").isNull(), 0)
        .otherwise(1 + F.pmod(F.xxhash64(*spread_on), F.lit(_SALTS)).cast("int")),
    )
    # A zero that depends on the row: a literal would be folded into a filter on the left side
    # and drop the salt from the shuffle key.
    zero = (F.col(weight) - F.col(weight)).cast("int")
    cold = lookup.select(*keys, zero.alias("_salt"), F.struct(*values).alias("_cold"))
    return marked.join(cold, [*keys, "_salt"], "left").select(
        *big.columns,
        *[F.coalesce(F.col(f"_heavy.{v}"), F.col(f"_cold.{v}")).alias(v) for v in values],
    )


# (dimension name, fact key, dimension table, dimension key)
Reference = tuple[str, str, DataFrame, str]


def _orders_per_key(facts: DataFrame, dims: Sequence[Reference]) -> DataFrame:
    """Fact rows per (dimension, key), from one scan; a hot key is combined to one row early."""
    pairs = facts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("missing_key"))
        for name, key, _, _ in dims
    ])).alias("p")).select("p.*")
    return pairs.groupBy("dimension", "missing_key").agg(F.count("*").alias("orphan_rows"))


def _members(dims: Sequence[Reference]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        dim.select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("missing_key"))
        for name, _, dim, key in dims
    ])


def unresolved_keys(facts: DataFrame, dims: Sequence[Reference]) -> DataFrame:
    """Fact rows without a dimension member: (dimension, missing_key, orphan_rows)."""
    return _orders_per_key(facts, dims).join(
        _members(dims), ["dimension", "missing_key"], "left_anti")


def orphan_summary(facts: DataFrame, dims: Sequence[Reference]) -> DataFrame:
    """One row per dimension with the number of orphan fact rows, zero included."""
    found = _orders_per_key(facts, dims).join(
        _members(dims).withColumn("_known", F.lit(True)), ["dimension", "missing_key"], "left")
    orphan = F.when(F.col("_known").isNull(), F.col("orphan_rows")).otherwise(0)
    return found.groupBy("dimension").agg(F.sum(orphan).alias("orphan_rows"))
