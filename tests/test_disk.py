"""What queries leave on disk while they run: freed shuffles, wide rows that move once."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F
from conftest import DATA
from test_gates import GOOD, SCHEMA
from test_near import exchanges, shuffled  # noqa: F401

from bayline import queries
from bayline.operators import gates, layout
from bayline.plans import warehouse
from bayline.plans.star import star
from bayline.session import shuffles_freed, stage
from bayline.sources import service_tables as src

SURVEYS = ("survey_id string, ro_number string, response struct<satisfaction int, would_recommend boolean, "
           "comments_present boolean>, channel string, arrival bigint")


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def left_behind(spark, write):
    """Shuffle files that a write leaves, some time after its end."""
    before = shuffle_files(spark)
    write(spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count().repartitionByRange("k"))
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_stored_tables_leave_no_shuffles(spark, tmp_path):
    assert left_behind(spark, lambda df: stage(df, "freed")) == set()
    assert left_behind(spark, lambda df: layout.publish({"t": df}, str(tmp_path))) == set()


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_the_setting_is_put_back(spark, before):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if before is not None:
        spark.conf.set(key, before)
    try:
        with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
            assert spark.conf.get(key) == "true"
            1 / 0
        assert spark.conf.get(key, None) == before
    finally:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Lines that come twice, with missing numbers, bad amounts and later, better copies of a number."""
    folder = str(tmp_path_factory.mktemp("tables"))
    lines = [(o, p, 1, n, float(q), 100.0 + p, 0.0, 0.02, "R", "O", day)
             for o, n, p, q, day in [
                 (3, 1, 5, 50, "1996-01-02"), (3, 1, 6, 2, "1996-01-03"), (3, 1, 6, 2, "1996-01-03"), (3, 2, 97, 4, "1996-02-01"),
                 (4, None, 7, 5, "1996-03-01"), (6, None, 8, 6, "1996-03-02"), (6, 1, 9, 7, "1996-04-01"),
                 (None, 1, 9, 7, "1996-04-01"), (9, 3, 4, 1, None), (9, 4, 4, 1, "1996-05-01")]]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate string").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).repartition(
                              4).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(o, o % 2, "O", 1.0, "1996-01-01", "1-URGENT") for o in (3, 4, 6, 9)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                          "o_orderdate string, o_orderpriority string").withColumn(
                              "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(0, "C0", 1, 1.0, "X"), (1, "C1", 1, 1.0, "X")], src.SCHEMAS["customer"]).write.parquet(
        f"{folder}/customer.parquet")
    for name in ("supplier", "part", "nation", "region"):
        spark.read.parquet(f"{DATA}/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def in_text(df):
    return sorted(map(str, df.collect()))


def test_the_published_fact_stays_where_its_orders_lie(spark, shuffled, monkeypatch, tables):  # noqa: F811
    published = []
    monkeypatch.setattr(queries.layout, "publish", lambda t, root: published.append(t) or layout.Commits(root).commit(t))
    queries.QUERIES["published_refresh"](spark, tables)
    fact = published[-1]["fact_repair_orders"]
    # Surveys by their number; no order moves by it.
    assert len(exchanges(fact, "ro_number", "_w0")) == 1
    whole = star(spark, tables).fact
    assert fact.columns == whole.columns and in_text(fact) == in_text(whole) and fact.count() == 4
    assert len(published) == 2 and published[0]["fact_repair_orders"].count() == 4


def odd_sources(spark):
    """Orders without a number, an empty one, members that come twice and members nobody knows."""
    changes = [
        {"ro_number": None}, {"ro_number": ""}, {}, {"ro_number": "B", "dealer_id": "D2"}, {"ro_number": "C", "vin": "V2"},
        {"ro_number": "D", "dealer_id": "D9"}, {"ro_number": "E", "vin": "V9", "dealer_id": None},
        {"ro_number": "F", "customer_email": None}, {"ro_number": "G", "customer_email": " A@x"}, {"ro_number": "G"},
    ]
    orders = spark.createDataFrame([(*{**GOOD, **c}.values(), i) for i, c in enumerate(changes)], SCHEMA)
    return warehouse.Sources(
        orders,
        spark.createDataFrame([("V1", "M", 2020, 36, None, 1), ("V2", "M", 2020, 36, None, 2), ("V2", "N", 2021, 36, None, 3)],
                              "vin string, model string, model_year int, warranty_months int, in_service_date date, arrival bigint"),
        spark.createDataFrame([("D1", "d", "r", 4, 1), ("D2", "d", "r", 4, 2), ("D2", "e", "r", 5, 3)],
                              "dealer_id string, dealer_name string, region string, service_bays int, arrival bigint"),
        spark.createDataFrame([("s1", "A", (4, True, False), "sms", 1), ("s2", "", (2, False, False), "sms", 2),
                               ("s3", None, (1, False, False), "sms", 3), ("s4", "A", (5, True, False), "sms", 4)], SURVEYS))


def test_narrow_lookups_give_the_same_fact_and_orphans(spark):
    s = odd_sources(spark)
    clean = stage(gates.passed(gates.protect_contacts(gates.gate_orders(s.orders))), "clean")
    dealers, vehicles, customers = warehouse.dim_dealer(s.dealers), warehouse.dim_vehicle(s.vehicles), warehouse.dim_customer(clean)
    orphans = warehouse.orphan_rejects(clean, dealers, vehicles)
    keys = warehouse.order_keys(clean, orphans)
    wide = warehouse.keyed_fact(warehouse.conform_fact(clean, dealers, vehicles, customers, s.surveys), keys)
    built = warehouse.build_warehouse(s)
    assert in_text(built.fact_repair_orders) == in_text(wide) and built.fact_repair_orders.columns == wide.columns
    assert in_text(built.dq_rejects.where("reason LIKE 'orphan%'")) == in_text(orphans)
    # Two dealers called D2, two vehicles called V2; D and E have no place.
    assert sorted((r.ro_key, r.ro_number or "", r.satisfaction_score) for r in built.fact_repair_orders.collect()) == [
        (1, "", None), (2, "A", 5), (3, "B", None), (3, "B", None), (4, "C", None), (4, "C", None), (5, "F", None), (6, "G", None)]
    hashes = [hashlib.sha256(email).hexdigest() for email in (b"a@x", b"")]
    assert sorted((r.customer_key, r.email_hash) for r in built.dim_customer.collect()) == [(1, hashes[0]), (2, hashes[1])]


def test_wide_orders_move_by_their_number_only(spark, shuffled):  # noqa: F811
    fact = warehouse.build_warehouse(odd_sources(spark)).fact_repair_orders
    assert exchanges(fact, "email_hash", "vin", "dealer_id", "_hash") == []
    assert len(exchanges(fact, "_number")) == 4  # orders, keys, members, surveys
    fact = queries.QUERIES["fact_repair_orders"](spark, f"{DATA}/sf0.001")
    assert exchanges(fact, "email_hash", "vin", "dealer_id", "_hash") == []


def test_stored_members_hold_natural_keys_of_orphans_only(spark):
    s = odd_sources(spark)
    clean = gates.passed(gates.protect_contacts(gates.gate_orders(s.orders)))
    found = warehouse.resolve_dimensions(
        clean, warehouse.dim_dealer(s.dealers), warehouse.dim_vehicle(s.vehicles), warehouse.dim_customer(clean))
    assert "email_hash" not in found.columns
    assert {(r.ro_number, r.dealer_id, r.vin) for r in found.where("dealer_id IS NOT NULL OR vin IS NOT NULL").collect()} == {
        ("D", "D9", "V1"), ("E", None, "V9")}


def test_orders_are_landed_in_order_from_narrow_rows(spark, tables):
    given = src.raw_orders(spark, tables, contacts=True)
    landed = queries._landed(star(spark, tables))
    texts = [c for c in landed.orders.columns if c != "arrival"]
    rows = lambda df: [tuple(r) for r in df.orderBy("arrival").select(*[F.col(c).cast("string") for c in texts]).collect()]
    assert rows(landed.orders) == rows(given)
    found = [r.survey_id for r in landed.surveys.orderBy("arrival").collect()]
    assert found == [r.survey_id for r in src.surveys(spark, tables).orderBy("arrival").collect()] and found
    for df in (src.raw_orders(spark, tables, contacts=True, in_order=True), src.surveys(spark, tables, in_order=True)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # What files hold is derived behind the shuffle by range.
        assert plan.index("AS ro_number") < plan.index("Exchange rangepartitioning(l_orderkey")
