"""Service-event ingestion: parse, validate, route bad events to a dead letter.

The input contract is that of a message bus: one column `value` with the raw bytes of a JSON
object. The same column expressions serve batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from bayline import schemas
from bayline.functions import in_domain, money, parse_date, present

# All fields are read as text: a JSON number or string both keep their digits, and the casts
# below decide what is acceptable.
_CORRUPT = "_corrupt"
_EVENT_TEXT = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in schemas.SERVICE_EVENT.fields]
    + [T.StructField(_CORRUPT, T.StringType())]
)


def parse_events(
    df: DataFrame, service_types: Iterable[str] = schemas.SERVICE_TYPES, keep: Iterable[str] = ()
) -> DataFrame:
    """Add the typed event fields, `raw` (text, bad bytes replaced) and `error`.

    `error` is NULL for a valid event and otherwise the code of the first rule it breaks.
    Non-integer dealer keys and NaN or missing amounts are errors, never NULLs or guesses.
    """
    text = F.col("value").cast("string")
    event = F.from_json(
        F.when(F.is_valid_utf8(text), text), _EVENT_TEXT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    # Exploding a one-element array keeps one row per message and parses each message once: the
    # optimizer would copy a plain projected parse into every expression and filter that uses it.
    parsed = df.select("*", text.alias("_text"), F.explode(F.array(event)).alias("_e"))
    e = lambda name: F.col(f"_e.{name}")
    amount, dealer, day = (
        money(e("total_amount")), e("dealer_key").try_cast("int"), parse_date(e("service_date")))
    score = e("satisfaction_score")
    error = (
        F.when(~F.coalesce(F.is_valid_utf8(F.col("_text")), F.lit(False)), "invalid_utf8")
        .when(F.col("_e").isNull() | e(_CORRUPT).isNotNull(), "malformed_json")
        .when(~present(e("ro_number")), "missing_ro_number")
        .when(~present(e("service_date")), "missing_service_date")
        .when(day.isNull(), "invalid_service_date")
        .when(~in_domain(e("service_type"), service_types), "invalid_service_type")
        .when(e("total_amount").isNull(), "missing_total_amount")
        .when(amount.isNull(), "invalid_total_amount")
        .when(amount < 0, "negative_total_amount")
        .when(dealer.isNull(), "invalid_dealer_key")
        .when(score.isNotNull() & score.try_cast("int").isNull(), "invalid_satisfaction_score")
    )
    return parsed.select(
        *keep,
        e("ro_number").alias("ro_number"),
        dealer.alias("dealer_key"),
        day.alias("service_date"),
        e("service_type").alias("service_type"),
        amount.alias("total_amount"),
        score.try_cast("int").alias("satisfaction_score"),
        F.make_valid_utf8("_text").alias("raw"),
        error.alias("error"),
    )


def valid_events(parsed: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return parsed.where(F.col("error").isNull()).select(
        *keep, *[f.name for f in schemas.SERVICE_EVENT.fields])


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("raw", "error")


def unique_events(
    events: DataFrame, event_time: str, delay: str, hot_keys: bool = True
) -> DataFrame:
    """Streaming deduplication on ro_number for redeliveries that arrive within `delay`.

    State is bounded by the delay: a repeat later than that passes, and an event older than the
    watermark is dropped by Spark and shows up in numRowsDroppedByWatermark.

    Copies of one number all meet in one task. With `hot_keys` they are first reduced to one per
    input task, so that a number that makes up much of a batch is spread over many tasks; that
    costs a second, equally bounded state. Turn it off for feeds without hot numbers.
    """
    unique = events.withWatermark(event_time, delay)
    if hot_keys:
        unique = (
            unique.withColumn("_slot", F.spark_partition_id())
            .dropDuplicatesWithinWatermark(["ro_number", "_slot"]).drop("_slot")
        )
    return unique.dropDuplicatesWithinWatermark(["ro_number"])
