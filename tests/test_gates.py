import hashlib
import json
from itertools import count

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from conftest import DATA

from bayline import schemas
from bayline.operators import gates
from bayline.operators.joins import spread_lookup
from bayline.sources import landing, service_tables

GOOD = dict(
    ro_number="A", dealer_id="D1", vin="V1", service_type="recall", open_date="2025-01-02",
    days_to_close="3", labor_amount="10.00", parts_amount="5.00", pay_type="warranty",
    customer_email="a@x", customer_phone="555-1234", repeat_repair_flag="0",
)
SCHEMA = ", ".join(f"{c} string" for c in GOOD) + ", arrival bigint"


def orders(spark, *changes):
    rows = [tuple({**GOOD, **c}.values()) + (i,) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, SCHEMA)


def reasons(gated):
    return [r.reason for r in gated.orderBy("arrival").select("reason").collect()]


def test_duplicates_are_judged_against_the_first_clean_row(spark):
    gated = gates.gate_orders(orders(
        spark, {"vin": None}, {}, {}, {"vin": ""},
    ))
    assert reasons(gated) == [
        "missing_vin", "", "duplicate_ro_number", "missing_vin,duplicate_ro_number"]


def test_every_failed_gate_is_listed_in_order(spark):
    gated = gates.gate_orders(orders(
        spark, {}, {"vin": None, "parts_amount": "-1", "service_type": None}))
    assert reasons(gated)[1] == (
        "missing_vin,negative_amount,duplicate_ro_number,invalid_service_type")


@pytest.mark.parametrize("change, reason", [
    ({"labor_amount": "abc"}, "unparsable_amount"),
    ({"parts_amount": "NaN"}, "unparsable_amount"),
    ({"labor_amount": None}, "unparsable_amount"),
    ({"open_date": "2025-02-30"}, "unparsable_date"),
    ({"days_to_close": "soon"}, "unparsable_number"),
    ({"labor_amount": "-0.01"}, "negative_amount"),
    ({"service_type": "wash"}, "invalid_service_type"),
])
def test_single_reasons(spark, change, reason):
    raw = orders(spark, change)
    assert reasons(gates.gate_orders(raw)) == [reason]
    assert gates.clean_orders(raw).count() == 0


def test_quarantine_keeps_the_whole_raw_row_but_no_plain_contact_data(spark):
    gated = gates.gate_orders(orders(spark, {"vin": None}))
    row = gates.quarantine(gated).first()
    contacts = {"email_hash": hashlib.sha256(b"a@x").hexdigest(), "phone_last4": "1234"}
    rest = {k: v for k, v in GOOD.items() if k not in ("customer_email", "customer_phone")}
    assert json.loads(row.raw_row) == {**rest, **contacts, "vin": None}


def test_missing_order_numbers_are_one_number_in_both_forms(spark):
    raw = orders(spark, {"ro_number": None}, {"ro_number": None}, {"ro_number": ""}, {})
    gated = gates.gate_orders(raw)
    assert reasons(gated) == ["", "duplicate_ro_number", "duplicate_ro_number", ""]
    assert sorted(r.arrival for r in gates.clean_orders(raw).collect()) == [0, 3]


@pytest.mark.parametrize("text", ["2024", "2024-3", "2024-01-05 junk", "2024-01-05T99", " 2024-01-05", "24-01-05"])
def test_only_whole_dates_pass(spark, text):
    assert reasons(gates.gate_orders(orders(spark, {"open_date": text}))) == ["unparsable_date"]


def test_both_forms_agree_on_the_supplied_orders(spark):
    raw = service_tables.raw_orders(spark, f"{DATA}/sf0.001")
    short, full = gates.clean_orders(raw), gates.passed(gates.gate_orders(raw))
    assert short.exceptAll(full).isEmpty() and full.exceptAll(short).isEmpty()


def brute_force(rows):
    seen, out = set(), []
    for key, vin, amount, kind in rows:
        bad = []
        if not vin:
            bad.append("missing_vin")
        if amount < 0:
            bad.append("negative_amount")
        if key in seen:
            bad.append("duplicate_ro_number")
        if kind not in schemas.SERVICE_TYPES:
            bad.append("invalid_service_type")
        if not bad:
            seen.add(key)
        out.append(",".join(bad))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from("ABC"), st.sampled_from(["V", ""]), st.sampled_from([1, -1]),
    st.sampled_from(["recall", "other"])), min_size=1, max_size=30))
def test_matches_a_row_by_row_reading(spark, rows):
    raw = orders(spark, *[
        {"ro_number": k, "vin": v, "labor_amount": str(a), "service_type": t}
        for k, v, a, t in rows])
    expected = brute_force(rows)
    assert reasons(gates.gate_orders(raw)) == expected
    clean = {r.arrival for r in gates.clean_orders(raw).select("arrival").collect()}
    assert clean == {i for i, reason in enumerate(expected) if not reason}


def test_a_hot_order_number_is_spread_over_the_join_partitions(spark):
    # One number owns a third of the rows.
    big = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("arrival"),
    )
    lookup = big.groupBy("k").agg(F.min("arrival").alias("first"), F.count("*").alias("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = spread_lookup(big, lookup, ["k"], "n", ["first"], [F.col("arrival")])
        assert out.count() == 30_000
        assert out.where("k = 'HOT' AND first <> 0 OR k <> 'HOT' AND first <> arrival").isEmpty()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1.5 * 30_000 / 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_csv_rows_keep_their_file_order(spark, tmp_path):
    numbers = count(1)
    for name in ("part-1.csv", "part-2.csv"):
        lines = [",".join(GOOD)]
        for _ in range(3):
            lines.append(",".join({**GOOD, "customer_phone": f"555-{next(numbers):04d}"}.values()))
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    raw = landing.read_orders(spark, str(tmp_path))
    got = [r.customer_phone for r in raw.orderBy("arrival").collect()]
    assert got == [f"555-{i:04d}" for i in range(1, 7)]
    assert [r.customer_phone for r in gates.clean_orders(raw).collect()] == ["555-0001"]
