import datetime as dt

import pytest
from pyspark.sql import functions as F

from bayline.operators import history, reconcile
from bayline.plans import governance


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, "h1", "0001", "consented"), (2, "h2", "0002", "ccpa_opt_out"),
         (3, "h3", "0003", "unknown"), (4, "h4", "0004", None)],
        "customer_key int, email_hash string, phone_last4 string, consent_status string")


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(f"R{i}", i % 5, dt.date(2020 + i % 4, 1, 1), 1, i) for i in range(40)]
    return spark.createDataFrame(
        rows, "ro_number string, customer_key int, service_month date, dealer_key int, amount int"
    ).withColumn("total_amount", F.col("amount").cast("decimal(18,2)"))


def test_erasure_removes_the_customer_and_no_fact(spark, customers, fact):
    left = governance.erase_customers(customers, spark.createDataFrame([("h2",), ("h2",)], "email_hash string"))
    assert {r.customer_key for r in left.collect()} == {1, 3, 4}
    assert fact.agg(F.sum("amount")).first()[0] == sum(range(40))


def test_opted_out_and_unknown_customers_stay_inside(customers, fact):
    shared = {r.customer_key for r in governance.external_share(fact, customers).collect()}
    assert shared == {1, 3, 4}


def test_erased_customers_stay_inside(spark, customers, fact):
    left = governance.erase_customers(customers, spark.createDataFrame([("h2",), ("h3",)], "email_hash string"))
    shared = {r.customer_key for r in governance.external_share(fact, left).collect()}
    assert shared == {1, 4}


def test_tiers_keep_every_amount_once(fact):
    tiers = governance.retention_tiers(fact, dt.date(2023, 6, 15), 24)
    detail = tiers.where("tier = 'detail'")
    assert detail.agg(F.min("service_month")).first()[0] == dt.date(2022, 1, 1)
    assert tiers.where("tier = 'monthly'").select("ro_number").distinct().first()[0] is None
    assert tiers.agg(F.sum("ro_count"), F.sum("total_amount")).first()[:] == (40, sum(range(40)))


@pytest.mark.parametrize("role, table, columns", [
    ("analyst", "dim_vehicle", ["model"]),
    ("cx_researcher", "dim_vehicle", ["vin", "model"]),
    ("governance", "dim_vehicle", ["vin", "model", "customer_email"]),
])
def test_roles_see_their_columns(spark, role, table, columns):
    df = spark.createDataFrame(
        [("v", "m", "a@b", "?")], "vin string, model string, customer_email string, unlabelled string")
    assert governance.apply_access(df, table, role).columns == columns


@pytest.mark.parametrize("role, table", [("analyst", "dim_customer"), ("visitor", "dim_date")])
def test_everything_else_is_denied(customers, role, table):
    with pytest.raises(governance.AccessDenied):
        governance.apply_access(customers, table, role)


def test_catalog_of_views(spark, customers):
    customers.createOrReplaceTempView("audited_customers")
    row = governance.pii_audit_of_catalog(spark, ["audited_customers"]).first()
    assert (row.raw_pii_columns, row.rows_with_email) == (0, 0)
    spark.catalog.dropTempView("audited_customers")
    got = {(r.column_name, r.status): r.filled_rows for r in governance.catalog_conformance(
        {"dim_customer": customers.drop("phone_last4")}).collect()}
    assert got["consent_status", "conforming"] == 3
    assert got["phone_last4", "declared_only"] == 0 and got["customer_key", "undeclared"] == 4


def test_history_closes_opens_and_keeps(spark):
    schema = "dealer_key int, name string, bays int"
    first = spark.createDataFrame([(1, "a", 4), (2, "b", 5), (3, "c", None)], schema)
    second = spark.createDataFrame([(1, "a", 4), (2, "b", 6), (3, "c", None), (4, "d", 7)], schema)
    opened = history.open_history(first, "2024-01-01")
    then = history.apply_changes(opened, second, "dealer_key", ["name", "bays"], "2024-06-01")
    day = lambda m: dt.date(2024, m, 1)
    rows = lambda df: sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[3]))
    assert rows(then) == [
        (1, "a", 4, day(1), None, True), (2, "b", 5, day(1), day(6), False),
        (2, "b", 6, day(6), None, True), (3, "c", None, day(1), None, True),
        (4, "d", 7, day(6), None, True)]
    again = history.apply_changes(then, second, "dealer_key", ["name", "bays"], "2024-07-01")
    assert rows(again) == rows(then)
    gone = history.apply_changes(then, second.where("dealer_key <> 4"), "dealer_key", ["name", "bays"], "2024-08-01")
    assert (4, "d", 7, day(6), day(8), False) in rows(gone)


def test_reconciliation_finds_each_kind_of_difference(spark):
    schema = "k int, a string, v int"
    old = spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "z", 3), (5, "r", 1), (5, "r", 2)], schema)
    new = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (4, "z", 9), (5, "r", 1), (5, "s", 2)], schema)
    got = {(r.measure, r.column_name): (r.old_value, r.new_value)
           for r in reconcile.reconcile(old, new, "k", ["a", "v"], ["v"]).collect()}
    assert got == {
        ("rows", "*"): (5.0, 5.0), ("sum", "v"): (9.0, 15.0),
        ("keys_on_one_side", "k"): (1.0, 1.0), ("repeated_keys", "k"): (1.0, 0.0),
        ("differing_fields", "a"): (1.0, 0.0), ("differing_fields", "v"): (0.0, 0.0)}
    assert reconcile.differing_rows(old, new).count() == 6
    thrice = old.where("k = 1").unionByName(old.where("k = 1")).unionByName(old.where("k = 1"))
    left = reconcile.differing_rows(thrice, new.where("k = 1"))
    assert [(r.k, r.side) for r in left.collect()] == [(1, "old")] * 2


def test_profile_forms_agree_on_small_data(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "n int, t string")
    exact = {r.column_name: r for r in reconcile.profile(df).collect()}
    quick = {r.column_name: r for r in reconcile.profile(df, approximate=True).collect()}
    for name, row in exact.items():
        assert row.asDict() == quick[name].asDict()
    assert exact["t"].null_count == 1 and exact["n"].distinct_count == 2
