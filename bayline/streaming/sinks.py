"""Streaming sinks whose result does not change when a micro-batch is replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from bayline import schemas
from bayline.operators.commits import DAY, Commits
from bayline.operators.files import Folder
from bayline.streaming.events import dead_letters, parse_events, valid_events

BATCH = "batch_id"
_MART_KEYS = ["month", "dealer_key"]
_MART_STORED = T.StructType([*schemas.MONTHLY_MART.fields, T.StructField(BATCH, T.LongType())])


def _compactions(path: str) -> str:
    return f"{path.rstrip('/')}-compacted"


def create_target(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty target; streams refuse to write where no target exists."""
    spark.createDataFrame([], schema).write.parquet(f"{path}/{BATCH}=-1")


def read_target(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of a target; its own files tell the columns where no schema is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop(BATCH)


def require_target(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Fail before the stream starts when the target is missing or has other columns."""
    if not Folder(spark, path).exists():
        raise ValueError(f"target {path} does not exist")
    found = read_target(spark, path).schema
    shape = lambda s: [(f.name, f.dataType) for f in s.fields]
    if shape(found) != shape(schema):
        raise ValueError(f"target {path} has columns {found.simpleString()}")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    # Each batch owns its folder, so a replayed batch replaces itself instead of appending.
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def route_events(
    stream: DataFrame, output: str, checkpoint: str, dead_letter: str | None = None,
    service_types=schemas.SERVICE_TYPES,
) -> DataStreamWriter:
    """Valid events to `output`, the rest to `dead_letter` (when given).

    Both writes of a micro-batch read one persisted parse of it.
    """
    spark = stream.sparkSession
    require_target(spark, output, schemas.SERVICE_EVENT)
    if dead_letter:
        require_target(spark, dead_letter, schemas.DEAD_LETTER)

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch, service_types)
        if not dead_letter:
            write_batch(valid_events(parsed), output, batch_id)
            return
        parsed = parsed.persist()
        try:
            write_batch(valid_events(parsed), output, batch_id)
            write_batch(dead_letters(parsed), dead_letter, batch_id)
        finally:
            parsed.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def run_available(writer: DataStreamWriter) -> None:
    """Process what is there now and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def append_files(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Plain exactly-once file sink for a single output; the target must exist."""
    require_target(df.sparkSession, path, df.schema)
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def monthly_mart(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep a monthly mart (month, dealer) current while events arrive; the target must exist.

    Update mode emits the absolute totals of the keys a batch has touched. They are appended in the
    batch's own folder, so no file of another batch is ever rewritten: a crash at any point loses
    nothing, and a replayed batch replaces itself. `read_monthly_mart` takes each key's newest totals.
    The state is one row per month and dealer.
    """
    require_target(events.sparkSession, path, schemas.MONTHLY_MART)
    totals = events.groupBy(
        F.trunc("service_date", "month").alias("month"), "dealer_key"
    ).agg(
        F.count("*").alias("ro_count"),
        F.sum("total_amount").cast(schemas.MONTHLY_MART["total_revenue"].dataType).alias("total_revenue"),
        F.sum("satisfaction_score").alias("score_sum"),
        F.count("satisfaction_score").alias("score_count"),
    )
    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
    )


def _newest(stored: DataFrame) -> DataFrame:
    """Per month and dealer, the row of the latest batch, with its batch."""
    values = [f.name for f in schemas.MONTHLY_MART.fields if f.name not in _MART_KEYS]
    return stored.groupBy(*_MART_KEYS).agg(
        F.max_by(F.struct(*values), F.col(BATCH)).alias("_last"), F.max(BATCH).alias(BATCH)
    ).select(*_MART_KEYS, "_last.*", BATCH)


def _stored_mart(spark: SparkSession, path: str) -> DataFrame:
    """The last compaction, if any, and the batches after it."""
    batches = spark.read.schema(_MART_STORED).parquet(path)
    commits = Commits(_compactions(path))
    if commits.latest(spark) is None:
        return batches
    compacted = commits.open(spark, "mart")
    done = compacted.agg(F.coalesce(F.max(BATCH), F.lit(-1))).scalar()
    return compacted.unionByName(batches.where(F.col(BATCH) > done))


def read_monthly_mart(spark: SparkSession, path: str) -> DataFrame:
    return _newest(_stored_mart(spark, path)).drop(BATCH)


def compact_monthly_mart(spark: SparkSession, path: str) -> None:
    """Commit the current totals as one table, so that readers skip the batches in it."""
    Commits(_compactions(path)).commit({"mart": _newest(_stored_mart(spark, path))})


def sweep_monthly_mart(spark: SparkSession, path: str, older_than: float = 7 * DAY) -> list[str]:
    """Remove compactions that were replaced, and batches that are in one, a given age ago."""
    commits = Commits(_compactions(path))
    swept = commits.sweep(spark, older_than)
    if commits.latest(spark) is None:
        return swept
    done = commits.open(spark, "mart").agg(F.max(BATCH)).scalar()
    return swept + remove_batches(spark, path, -1 if done is None else done, older_than)


def remove_batches(spark: SparkSession, path: str, done: int, older_than: float) -> list[str]:
    """Remove the folders of micro-batches up to `done` that a compaction holds.

    The newest batch stays: Spark may run it again. So does the empty one that carries the columns.
    """
    folder = Folder(spark, path)
    numbers = sorted(int(n.partition("=")[2]) for n in folder.names() if n.startswith(f"{BATCH}="))
    names = [f"{BATCH}={n}" for n in numbers[:-1] if 0 <= n <= done]
    old = [n for n in names if folder.age(n) >= older_than]
    for name in old:
        folder.remove(name)
    return old
