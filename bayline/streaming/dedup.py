"""Exact deduplication of an at-least-once feed, however late a message is delivered again.

The numbers that have passed are kept as a log on shared storage instead of in streaming state:
files of (bucket, number) by micro-batch, and beside them a summary, bitmaps of the slots of a hash
that are taken. A micro-batch looks its numbers up in the summary first. A number in a free slot is
new without any further reading; only for the others, the buckets that hold their slots are read.
Each micro-batch owns its folders and reads those of earlier ones only, so a replay changes nothing
whatever a crash left behind. Nothing is kept in streaming state or memory between micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from bayline.operators.commits import DAY, Commits
from bayline.operators.registry import same
from bayline.session import stage
from bayline.streaming.sinks import BATCH, remove_batches, require_target, write_batch

# A number's slot is a part of its hash; a bitmap has 32,768 of them.
SLOTS = 1 << 36
BUCKETS = 64
_PER_BITMAP = 32_768
_NUMBER, _SLOT, _BUCKET, _PART, _BITS = "number", "_slot", "bucket", "part", "bits"

KEYS = T.StructType([T.StructField(_NUMBER, T.StringType())])
SUMMARY = T.StructType([T.StructField(_PART, T.LongType()), T.StructField(_BITS, T.BinaryType())])
_BY_BATCH = [T.StructField(BATCH, T.LongType())]


def _slot(number: Column) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(SLOTS))


def _bucket(slot: Column) -> Column:
    return F.floor(slot / (SLOTS // BUCKETS)).cast("int")


def _is_taken(bits: Column, slot: Column) -> Column:
    """The bit of a slot in its bitmap: bytes in order, the lowest bit of a byte first."""
    position = slot % _PER_BITMAP
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


@dataclass(frozen=True)
class KeyLog:
    """The numbers that earlier micro-batches let pass."""

    path: str

    def create(self, spark: SparkSession) -> None:
        # The empty folder has both levels, as those of the micro-batches have.
        spark.createDataFrame([], KEYS).write.parquet(f"{self.path}/keys/{BATCH}=-1/{_BUCKET}=0")
        spark.createDataFrame([], SUMMARY).write.parquet(f"{self.path}/summary/{BATCH}=-1")

    @property
    def compacted(self) -> Commits:
        return Commits(f"{self.path}/compacted")

    def _stored(self, spark: SparkSession, name: str, schema: T.StructType, before: int) -> DataFrame:
        """Rows of the batches before one: the newest compaction, and the batches after it."""
        rows = spark.read.schema(schema).parquet(f"{self.path}/{name}").where(F.col(BATCH) < before)
        if self.compacted.latest(spark) is None:
            return rows
        whole = self.compacted.open(spark, name)
        return whole.unionByName(rows.where(F.col(BATCH) > self._compacted_to(spark)))

    def _compacted_to(self, spark: SparkSession) -> int:
        return self.compacted.open(spark, "reach").first()[0]

    def keys(self, spark: SparkSession, before: int) -> DataFrame:
        schema = T.StructType([*KEYS.fields, *_BY_BATCH, T.StructField(_BUCKET, T.IntegerType())])
        return self._stored(spark, "keys", schema, before)

    def summary(self, spark: SparkSession, before: int) -> DataFrame:
        return self._stored(spark, "summary", T.StructType([*SUMMARY.fields, *_BY_BATCH]), before)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Commit all batches up to one, which must be older than the newest, as one table.

        The newest batch may be run again and must then find only the batches before it.
        """
        keys = self.keys(spark, upto + 1).withColumn(BATCH, F.lit(upto).cast("long"))
        bitmaps = self.summary(spark, upto + 1).groupBy(_PART).agg(F.expr(f"bitmap_or_agg({_BITS})").alias(_BITS))
        self.compacted.commit({
            "keys": keys.repartitionByRange(_BUCKET, _NUMBER).sortWithinPartitions(_BUCKET, _NUMBER),
            "summary": bitmaps.withColumn(BATCH, F.lit(upto).cast("long")),
            "reach": spark.range(1).select(F.lit(upto).cast("long").alias(BATCH)),
        })

    def sweep(self, spark: SparkSession, older_than: float = 7 * DAY) -> list[str]:
        """Remove replaced compactions and compacted batches of a given age."""
        if self.compacted.latest(spark) is None:
            return []
        reach = self._compacted_to(spark)
        return self.compacted.sweep(spark, older_than) + [
            n for name in ("keys", "summary") for n in remove_batches(spark, f"{self.path}/{name}", reach, older_than)]

    def doubtful(self, numbers: DataFrame, before: int) -> DataFrame:
        """The numbers whose slot is taken: all that passed before, and few others."""
        slots = numbers.select(_NUMBER, _slot(F.col(_NUMBER)).alias(_SLOT))
        bitmaps = self.summary(numbers.sparkSession, before).groupBy(_PART).agg(
            F.expr(f"bitmap_or_agg({_BITS})").alias(_BITS))
        return (slots.withColumn(_PART, F.floor(F.col(_SLOT) / _PER_BITMAP)).join(bitmaps, _PART)
                .where(_is_taken(F.col(_BITS), F.col(_SLOT)))
                .select(_NUMBER, _bucket(F.col(_SLOT)).alias(_BUCKET)))

    def passed(self, numbers: DataFrame, before: int) -> DataFrame:
        """Those of distinct numbers that an earlier micro-batch let pass."""
        spark = numbers.sparkSession
        doubtful = stage(self.doubtful(numbers, before), "doubtful")
        # At most BUCKETS values, which let Spark skip the other folders.
        buckets = [r[0] for r in doubtful.select(_BUCKET).distinct().collect()]
        keys = self.keys(spark, before).where(F.col(_BUCKET).isin(buckets))
        return doubtful.join(keys, same(doubtful, keys, [_BUCKET, _NUMBER]), "left_semi").select(_NUMBER)

    def add(self, numbers: DataFrame, batch_id: int) -> None:
        """Record distinct numbers as a micro-batch's own."""
        slots = numbers.select(_NUMBER, _slot(F.col(_NUMBER)).alias(_SLOT))
        slots.select(_NUMBER, _bucket(F.col(_SLOT)).alias(_BUCKET)).repartition(_BUCKET).sortWithinPartitions(
            _BUCKET, _NUMBER).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/keys/{BATCH}={batch_id}")
        slots.groupBy(F.floor(F.col(_SLOT) / _PER_BITMAP).alias(_PART)).agg(
            F.expr(f"bitmap_construct_agg({_SLOT} % {_PER_BITMAP})").alias(_BITS)
        ).write.mode("overwrite").parquet(f"{self.path}/summary/{BATCH}={batch_id}")


def first_of_each(events: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by `order`; Spark cuts to one row per key before the shuffle, so
    copies of a hot key don't gather."""
    first = Window.partitionBy(key).orderBy(*order)
    return events.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def unique_sink(
    events: DataFrame, output: str, log: KeyLog, checkpoint: str, key: str = "ro_number",
    order: Sequence[str] | None = None,
) -> DataStreamWriter:
    """Write every event whose number no earlier event had; target and log must exist.

    Of equal numbers in one micro-batch the first by `order` (all columns, unless given) passes.
    """
    spark = events.sparkSession
    require_target(spark, output, events.schema)
    by = list(order or events.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        arriving = stage(first_of_each(batch, key, by), "arriving")
        known = log.passed(arriving.select(F.col(key).alias(_NUMBER)), batch_id)
        fresh = stage(arriving.join(known, F.col(key).eqNullSafe(F.col(_NUMBER)), "left_anti"), "fresh")
        write_batch(fresh, output, batch_id)
        log.add(fresh.select(F.col(key).alias(_NUMBER)), batch_id)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
