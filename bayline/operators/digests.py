"""Comparison of two tables by digests, reading rows only where they differ.

A row's hash falls into a bucket by its key. Each side is folded into a digest per bucket: row
count and a sum of row hashes, which doesn't depend on order and tells repeated rows. Buckets form
two levels: unlike coarse buckets are looked into by their fine ones, and only rows of unlike fine
buckets are compared. What is shuffled for equal tables is one row per task and bucket. The digest
of a table can be stored with it, so that a later comparison reads the other side alone; the same
record carries profile figures that merge: nulls, smallest, largest, and a distinct-count sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from bayline.operators.reconcile import differing_rows
from bayline.session import stage

COARSE, FINE = 256, 256


def _bucket(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(COARSE * FINE)).cast("int")


def _row_hash(columns: Sequence[str]) -> Column:
    """A hash that tells NULL from other values in each place, which xxhash64 alone skips."""
    marks = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(*columns, marks)


def digest(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(bucket, n, digest) of every fine bucket that has rows."""
    hashed = df.select(_bucket(key).alias("bucket"), _row_hash(df.columns).alias("hash"))
    # Sums of decimals, as sums of longs would overflow.
    return hashed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(F.col("hash").cast("decimal(20,0)")).alias("digest"))


def _coarse(digests: DataFrame) -> DataFrame:
    return digests.groupBy(F.floor(F.col("bucket") / FINE).cast("int").alias("bucket")).agg(
        F.sum("n").alias("n"), F.sum(F.xxhash64("bucket", "digest").cast("decimal(20,0)")).alias("digest"))


def _unlike(left: DataFrame, right: DataFrame) -> list[int]:
    """Buckets whose digests differ, those of one side only among them; COARSE * FINE at most."""
    one = left.select("bucket", F.struct("n", "digest").alias("l"))
    other = right.select("bucket", F.struct("n", "digest").alias("r"))
    return [r[0] for r in one.join(other, "bucket", "full").where(~F.col("l").eqNullSafe(F.col("r"))).select("bucket").collect()]


def unlike_buckets(left: DataFrame, right: DataFrame) -> list[int]:
    """Fine buckets in which two digests differ; fine ones are only looked at in unlike coarse ones."""
    coarse = _unlike(_coarse(left), _coarse(right))
    if not coarse:
        return []
    inside = F.floor(F.col("bucket") / FINE).isin(coarse)
    return _unlike(left.where(inside), right.where(inside))


def narrowed_difference(
    old: DataFrame, new: DataFrame, key: Sequence[str], stored: DataFrame | None = None
) -> DataFrame:
    """`differing_rows` of two tables with the same columns, from the rows of unlike buckets only.

    `stored` may be the digest of `old`, kept from before.
    """
    left = stage(digest(old, key), "digest") if stored is None else stored
    right = stage(digest(new.select(*old.columns), key), "digest")
    buckets = unlike_buckets(left, right)
    inside = _bucket(key).isin(buckets) if buckets else F.lit(False)
    return differing_rows(old.where(inside), new.select(*old.columns).where(inside))


def profile_record(df: DataFrame, part: str) -> DataFrame:
    """Per value of `part` and column: mergeable figures, in one pass."""
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(isinstance(f.dataType, T.NumericType)).alias("is_number"),
            F.count("*").alias("row_count"), F.count_if(F.col(f.name).isNull()).alias("null_count"),
            F.min(f.name).cast("string").alias("min_value"), F.max(f.name).cast("string").alias("max_value"),
            F.hll_sketch_agg(F.col(f.name).cast("string"), 12).alias("sketch"))
        for f in df.schema.fields if f.name != part]
    return df.groupBy(part).agg(F.array(*entries).alias("rows")).select(part, F.inline("rows"))


def merged_profile(records: DataFrame) -> DataFrame:
    """The profile of a whole table from the records of its parts; distinct values are estimated."""
    def extreme(value: str, of_text, of_number) -> Column:
        # Numbers are told as text, but compare as numbers.
        number = F.col(value).try_cast("double")
        return F.when(F.first("is_number"), of_number(value, number)).otherwise(of_text(value)).alias(value)

    return records.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        extreme("min_value", F.min, F.min_by), extreme("max_value", F.max, F.max_by),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
