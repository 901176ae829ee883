"""Orders that lie together by a column their number determines: the same rows, fewer shuffles."""

import re

import pytest
from pyspark.sql import functions as F
from conftest import DATA
from test_gates import GOOD, SCHEMA, reasons

from bayline import queries
from bayline.operators import gates
from bayline.plans import warehouse
from bayline.plans.star import star
from bayline.session import stage

ROWS = [  # order number, the column beside it, whether the row passes the other gates
    ("B", 2, False), (None, 1, False), (None, 5, True), ("", 3, True), ("A", 1, True), (None, 1, True), ("A", 1, True),
    ("C", 1, True), ("B", 2, True), ("B", 2, True), ("A", 1, False),
]


def placed(spark):
    rows = [(*{**GOOD, "ro_number": n, "vin": "V1" if ok else None}.values(), i, b) for i, (n, b, ok) in enumerate(ROWS)]
    return spark.createDataFrame(rows, f"{SCHEMA}, {gates.NEAR} bigint").repartition(4)


def test_both_forms_agree_with_and_without_the_column(spark):
    raw = placed(spark)
    plain = raw.drop(gates.NEAR)
    assert reasons(gates.gate_orders(raw)) == reasons(gates.gate_orders(plain)) == [
        "missing_vin", "missing_vin", "", "duplicate_ro_number", "", "duplicate_ro_number", "duplicate_ro_number",
        "", "", "duplicate_ro_number", "missing_vin,duplicate_ro_number"]
    assert gates.gate_orders(raw).columns == gates.gate_orders(plain).columns
    for form in (raw, plain):
        assert sorted(r.arrival for r in gates.clean_orders(form).collect()) == [2, 4, 7, 8]


@pytest.fixture
def shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df, *keys):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [e for e in re.findall(r"Exchange hashpartitioning\(([^\n]*)", plan) if any(k in e for k in keys)]


def test_orders_stay_where_their_join_has_put_them(spark, shuffled):
    s = star(spark, f"{DATA}/sf0.001")
    # Lines by their order; of the lookup one exchange, the orders not again.
    assert len(exchanges(gates.clean_orders(s.raw_orders), "ro_number", "_w0", "_near")) == 0
    assert len(exchanges(gates.gate_orders(s.raw_orders), "_number", "_near")) == 1


def test_surveys_and_keys_share_a_shuffle_of_the_fact(spark, shuffled):
    clean = placed(spark).where("arrival IN (2, 4, 7, 8)").drop(gates.NEAR)
    surveys = spark.createDataFrame(
        [("s1", "A", (4, True, False), "sms", 1), ("s2", "", (2, False, False), "sms", 2), ("s3", None, (1, False, False), "sms", 3)],
        "survey_id string, ro_number string, response struct<satisfaction int, would_recommend boolean, "
        "comments_present boolean>, channel string, arrival bigint")
    dealers = spark.createDataFrame([("D1", 7)], "dealer_id string, dealer_key bigint")
    vehicles = spark.createDataFrame([("V1", 8)], "vin string, vehicle_key bigint")
    customers = warehouse.dim_customer(clean)
    keys = warehouse.order_keys(clean, spark.createDataFrame([], "ro_number string"))
    fact = warehouse.keyed_fact(warehouse.conform_fact(clean, dealers, vehicles, customers, surveys), keys)
    # The fact once, the surveys once, the keys once.
    assert len(exchanges(fact, "_number", "ro_number")) == 3
    # No survey without a number answers for an order without one, nor does an empty number.
    assert sorted((r.ro_key, r.ro_number, r.satisfaction_score, r.customer_key) for r in fact.collect()) == [
        (1, None, None, 1), (2, "A", 4, 1), (3, "C", None, 1), (4, "B", None, 1)]


def conformed(spark):
    clean = placed(spark).where("arrival IN (2, 4, 7, 8)").drop(gates.NEAR)
    surveys = spark.createDataFrame(
        [], "survey_id string, ro_number string, response struct<satisfaction int, would_recommend boolean, "
        "comments_present boolean>, channel string, arrival bigint")
    dealers = spark.createDataFrame([("D1", 7)], "dealer_id string, dealer_key bigint")
    vehicles = spark.createDataFrame([("V1", 8)], "vin string, vehicle_key bigint")
    return clean, warehouse.conform_fact(clean, dealers, vehicles, warehouse.dim_customer(clean), surveys)


def test_the_fact_derives_its_columns_after_its_shuffles(spark, shuffled):
    plan = conformed(spark)[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.index("AS total_amount") < plan.index("SortMergeJoin")
    assert plan.index("AS open_date_key") < plan.index("SortMergeJoin")


def test_numbers_are_stored_without_what_they_were_sorted_by(spark):
    keys = warehouse.order_keys(conformed(spark)[0], spark.createDataFrame([], "ro_number string"))
    stored = {c for f in keys.inputFiles() if "/position-" in f for c in spark.read.parquet(f).columns}
    assert "ro_number" in stored and "arrival" not in stored
    assert sorted((r.ro_key, r.ro_number or "") for r in keys.collect()) == [(1, ""), (2, "A"), (3, "C"), (4, "B")]


@pytest.mark.parametrize("beside", [True, False])
def test_numbers_that_come_once_meet_earlier_loads_without_their_arrival(spark, monkeypatch, beside):
    kept = []
    monkeypatch.setattr(gates, "stage", lambda df, *rest: kept.append(stage(df, *rest)) or kept[-1])
    raw = placed(spark) if beside else placed(spark).drop(gates.NEAR)
    seen = spark.createDataFrame([("C",), ("Z",)], "ro_number string")
    assert reasons(gates.gate_orders(raw, seen=seen)) == [
        "missing_vin", "missing_vin", "", "duplicate_ro_number", "", "duplicate_ro_number", "duplicate_ro_number",
        "duplicate_ro_number", "", "duplicate_ro_number", "missing_vin,duplicate_ro_number"]
    found = {r["_number"]: r["_first_clean"] for r in kept[0].where("_number <> ''").collect()}
    assert found == {"A": 4, "B": 8, "C": None}


def test_landing_files_are_compressed(spark):
    landed = queries._landed(star(spark, f"{DATA}/sf0.001"))
    assert all(f.endswith(".gz") for df in (landed.orders, landed.surveys) for f in df.inputFiles())


def test_the_feed_is_written_by_all_tasks(spark):
    files = spark.read.parquet(queries._delivered_again(star(spark, f"{DATA}/sf0.001"))).inputFiles()
    assert len(files) >= 2 * spark.sparkContext.defaultParallelism
