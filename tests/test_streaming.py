import json
import os

import pytest
from pyspark.sql import functions as F

from bayline import schemas
from bayline.session import scratch_path
from bayline.streaming import events, sinks

GOOD = {"ro_number": "R1", "dealer_key": 7, "service_date": "2025-01-02",
        "service_type": "recall", "total_amount": 12.5, "satisfaction_score": 4}


def raw(**change):
    event = {k: v for k, v in {**GOOD, **change}.items() if v != "-"}
    return json.dumps(event).encode()


CASES = [
    (raw(), None),
    (raw(satisfaction_score=None), None),
    (raw(dealer_key="7", total_amount="12.50"), None),
    (raw(total_amount=0), None),
    (b"\xff\xfe{", "invalid_utf8"),
    (b"{not json", "malformed_json"),
    (b"[1]", "malformed_json"),
    (b"", "malformed_json"),
    (None, "invalid_utf8"),
    (raw(ro_number="-"), "missing_ro_number"),
    (raw(ro_number=""), "missing_ro_number"),
    (raw(service_date=None), "missing_service_date"),
    (raw(service_date="soon"), "invalid_service_date"),
    (raw(service_type="wash"), "invalid_service_type"),
    (raw(service_type=None), "invalid_service_type"),
    (raw(total_amount="-"), "missing_total_amount"),
    (raw(total_amount="NaN"), "invalid_total_amount"),
    (raw(total_amount="abc"), "invalid_total_amount"),
    (raw(total_amount=-0.01), "negative_total_amount"),
    (raw(dealer_key=12.7), "invalid_dealer_key"),
    (raw(dealer_key="-"), "invalid_dealer_key"),
    (raw(satisfaction_score="good"), "invalid_satisfaction_score"),
]


def messages(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value binary")


def test_every_kind_of_bad_event_has_its_code(spark):
    parsed = events.parse_events(messages(spark, [c[0] for c in CASES]), keep=["n"])
    got = {r.n: r.error for r in parsed.collect()}
    assert [got[i] for i in range(len(CASES))] == [c[1] for c in CASES]


def test_valid_events_are_typed_and_bad_bytes_stay_readable(spark):
    parsed = events.parse_events(messages(spark, [raw(), b"\xff\xfe{"]))
    valid = events.valid_events(parsed)
    assert [(f.name, f.dataType) for f in valid.schema] == [
        (f.name, f.dataType) for f in schemas.SERVICE_EVENT]
    row = valid.first()
    assert (row.dealer_key, str(row.total_amount), str(row.service_date)) == (7, "12.50", "2025-01-02")
    assert events.dead_letters(parsed).first().raw == "��{"


@pytest.fixture
def feed(spark, tmp_path):
    """A directory that is streamed as messages; `put` adds one file."""
    folder = str(tmp_path / "feed")

    def put(values):
        messages(spark, values).select("value").coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(folder)

    return put, stream


def targets(spark):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    sinks.create_target(spark, good, schemas.SERVICE_EVENT)
    sinks.create_target(spark, bad, schemas.DEAD_LETTER)
    return good, bad


def test_routing_and_replay(spark, feed):
    put, stream = feed
    put([c[0] for c in CASES])
    good, bad = targets(spark)
    # A second run from an empty checkpoint replays batch 0: it must replace itself.
    for _ in range(2):
        sinks.run_available(
            sinks.route_events(stream(), good, scratch_path(spark, "state"), bad))
    valid = sum(c[1] is None for c in CASES)
    assert sinks.read_target(spark, good).count() == valid
    assert sinks.read_target(spark, bad).count() == len(CASES) - valid


def test_without_a_dead_letter_target_only_valid_events_are_kept(spark, feed):
    put, stream = feed
    put([raw(), b"bad"])
    good, _ = targets(spark)
    sinks.run_available(sinks.route_events(stream(), good, scratch_path(spark, "state")))
    assert sinks.read_target(spark, good).count() == 1


def test_the_target_must_exist_and_match(spark, feed):
    put, stream = feed
    put([raw()])
    with pytest.raises(ValueError):
        sinks.route_events(stream(), scratch_path(spark, "none"), "unused")
    _, bad = targets(spark)
    with pytest.raises(ValueError):
        sinks.route_events(stream(), bad, "unused")


@pytest.mark.parametrize("hot_keys", [True, False])
def test_redelivered_events_are_stored_once(spark, tmp_path, hot_keys):
    folder = str(tmp_path / "timed")
    spark.range(20).select(
        F.concat(F.lit("R"), F.col("id") % 15).alias("ro_number"),
        (F.lit("2025-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int")))
        .alias("ts"),
    ).repartition(4).write.parquet(folder)
    stream = spark.readStream.schema("ro_number string, ts timestamp").option(
        "maxFilesPerTrigger", 2).parquet(folder)
    out = scratch_path(spark, "unique")
    with pytest.raises(ValueError):
        sinks.append_files(stream, out, "unused")
    sinks.create_target(spark, out, stream.schema)
    sinks.run_available(sinks.append_files(
        events.unique_events(stream, "ts", "1 day", hot_keys), out, scratch_path(spark, "state")))
    assert spark.read.schema("ro_number string, ts timestamp").parquet(out).count() == 15


def test_the_mart_stays_current_over_several_batches(spark, feed):
    put, stream = feed
    everything = []
    path, state = scratch_path(spark, "mart"), scratch_path(spark, "state")
    sinks.create_target(spark, path, schemas.MONTHLY_MART)
    for batch in range(3):
        values = [
            raw(ro_number=f"R{batch}-{i}", dealer_key=(i + batch) % 4, total_amount=i,
                service_date=f"2025-0{1 + (i + batch) % 3}-05")
            for i in range(10)
        ]
        everything += values
        put(values)
        parsed = events.valid_events(events.parse_events(stream()))
        sinks.run_available(sinks.monthly_mart(parsed, path, state))
        if batch == 1:
            sinks.compact_monthly_mart(spark, path)
    batch = events.valid_events(events.parse_events(messages(spark, everything)))
    expected = batch.groupBy(F.trunc("service_date", "month").alias("month"), "dealer_key").agg(
        F.count("*").alias("n"), F.sum("total_amount").cast("double").alias("v"))
    got = sinks.read_monthly_mart(spark, path).select(
        "month", F.col("dealer_key"), F.col("ro_count").alias("n"),
        F.col("total_revenue").cast("double").alias("v"))
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_a_lost_batch_folder_comes_back_with_the_replay(spark, feed):
    put, stream = feed
    path, state = scratch_path(spark, "mart"), scratch_path(spark, "state")
    put([raw(ro_number=f"A{i}", dealer_key=i % 3, total_amount=i) for i in range(9)])
    parsed = events.valid_events(events.parse_events(stream()))
    with pytest.raises(ValueError):
        sinks.monthly_mart(parsed, path, state)
    sinks.create_target(spark, path, schemas.MONTHLY_MART)
    sinks.run_available(sinks.monthly_mart(parsed, path, state))
    first = sorted(map(tuple, sinks.read_monthly_mart(spark, path).collect()))
    # The job died after the batch was written and before it was committed; its files are gone.
    folder = path.removeprefix("file:")
    for kept in sorted(os.listdir(f"{state.removeprefix('file:')}/commits")):
        os.remove(f"{state.removeprefix('file:')}/commits/{kept}")
    for name in os.listdir(folder):
        if name == "batch_id=0":
            for f in os.listdir(f"{folder}/{name}"):
                os.remove(f"{folder}/{name}/{f}")
    sinks.run_available(sinks.monthly_mart(parsed, path, state))
    assert sorted(map(tuple, sinks.read_monthly_mart(spark, path).collect())) == first
