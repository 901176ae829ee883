"""The supplied events table as a feed of JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bayline.sources.service_tables import SCHEMAS, table, table_path

# The feed's own event types stand in for service types; `signup` is left out on purpose and
# ends up in the dead letter.
FEED_TYPES = ("view", "error", "click", "purchase")


def _message() -> F.Column:
    return F.to_json(F.struct(
        F.col("event_id").cast("string").alias("ro_number"),
        F.col("user_id").alias("dealer_key"),
        F.date_format("ts", "yyyy-MM-dd").alias("service_date"),
        F.col("event_type").alias("service_type"),
        F.col("value").cast("decimal(18,2)").alias("total_amount"),
        F.get_json_object("props", "$.k").cast("int").alias("satisfaction_score"),
    )).cast("binary")


def messages(events: DataFrame) -> DataFrame:
    """`value` (bytes) and the event time."""
    return events.select(_message().alias("value"), F.col("ts").cast("timestamp").alias("ts"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream over the table's files."""
    # Written as a pattern because a stream takes a plain path for a directory, and the table
    # may be one file as well as a directory of them.
    files = table_path(sf_dir, "events")[:-1] + "[t]"
    return messages(spark.readStream.schema(SCHEMAS["events"]).parquet(files))


def event_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(table(spark, sf_dir, "events"))


def redelivered(feed: DataFrame) -> DataFrame:
    """An at-least-once feed: about every third message comes twice."""
    copies = F.when(F.pmod(F.xxhash64("value"), F.lit(3)) == 0, 2).otherwise(1)
    return feed.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
