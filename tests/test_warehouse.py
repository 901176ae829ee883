import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from bayline import schemas
from bayline.operators import audit, checks, joins, layout
from bayline.plans import governance, kpis, retention, views, warehouse
from bayline.sources import landing

HEADER = [f.name for f in schemas.ORDERS_CSV.fields]
TYPES = schemas.SERVICE_TYPES


def order(i, **change):
    row = dict(
        ro_number=f"RO{i:03d}", dealer_id=f"D{i % 3}", vin=f"V{i % 5}",
        service_type=TYPES[i % 5], open_date=f"2025-0{1 + i % 6}-1{i % 10}",
        days_to_close=str(i % 4 + 1), labor_amount=f"{100 + i}.25", parts_amount="10.50",
        pay_type="customer", customer_email=f" User{i % 7}@X.test", customer_phone=f"555-{i:04d}",
        repeat_repair_flag=str(i % 2),
    )
    return {**row, **change}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    orders = [order(i) for i in range(60)]
    orders += [order(60, vin=""), order(61, labor_amount="-5"), order(5), order(62, vin="V9")]
    (root / "orders.csv").write_text(
        "\n".join([",".join(HEADER)] + [",".join(o[h] for h in HEADER) for o in orders]))
    (root / "vehicles.csv").write_text("vin,model,model_year,warranty_months,in_service_date\n" + "\n".join(
        f"V{i},Model{i},2020,36,2020-0{i + 1}-01" for i in range(5)))
    (root / "dealers.csv").write_text("dealer_id,dealer_name,region,service_bays\n" + "\n".join(
        f"D{i},Dealer {i},Region {i % 2},{6 + i}" for i in range(3)))
    surveys = [
        {"survey_id": f"S{i}", "ro_number": f"RO{i % 21:03d}", "channel": "email",
         "response": {"satisfaction": 1 + i % 5, "would_recommend": i % 2 == 0,
                      "comments_present": False}}
        for i in range(24)
    ]
    (root / "surveys.json").write_text(json.dumps(surveys))
    return root


@pytest.fixture(scope="module")
def sources(spark, files):
    return warehouse.Sources(
        landing.read_orders(spark, f"{files}/orders.csv"),
        landing.read_vehicles(spark, f"{files}/vehicles.csv"),
        landing.read_dealers(spark, f"{files}/dealers.csv"),
        landing.read_surveys(spark, f"{files}/surveys.json"),
    )


@pytest.fixture(scope="module")
def built(sources):
    return warehouse.build_warehouse(sources)


def test_schemas_are_the_declared_ones(built):
    shape = lambda s: [(f.name, f.dataType) for f in s.fields]
    for name, schema in [
        ("dim_dealer", schemas.DIM_DEALER), ("dim_vehicle", schemas.DIM_VEHICLE),
        ("dim_customer", schemas.DIM_CUSTOMER), ("dim_date", schemas.DIM_DATE),
        ("fact_repair_orders", schemas.FACT),
    ]:
        assert shape(getattr(built, name).schema) == shape(schema), name


def test_no_orphans(built):
    dims = [
        ("dealer", "dealer_key", built.dim_dealer, "dealer_key"),
        ("vehicle", "vehicle_key", built.dim_vehicle, "vehicle_key"),
        ("customer", "customer_key", built.dim_customer, "customer_key"),
        ("date", "open_date_key", built.dim_date, "date_key"),
    ]
    got = joins.orphan_summary(built.fact_repair_orders, dims).collect()
    assert sorted(map(tuple, got)) == [
        ("customer", 0), ("date", 0), ("dealer", 0), ("vehicle", 0)]


def test_extract_balances_with_load_and_rejects(built):
    rows = {(r.stage, r.entity): r.row_count for r in built.etl_audit.collect()}
    assert rows["extract", "orders"] == 64
    assert rows["validate", "orders_rejected"] == 3
    # The order with an unknown vehicle passed the gates but could not be loaded.
    assert rows["load", "fact_repair_orders"] == 60
    assert rows["validate", "orphans_rejected"] == 1
    balance = audit.audit_balance(built.etl_audit).first()
    assert balance.balanced == 1
    assert built.dq_rejects.count() == 4


def test_rejects_have_their_reasons(built):
    got = {r.ro_number: r.reason for r in built.dq_rejects.collect()}
    assert got == {
        "RO060": "missing_vin", "RO061": "negative_amount", "RO005": "duplicate_ro_number",
        "RO062": "orphan_vehicle"}
    assert checks.failed(checks.run_checks(built.dq_rejects, checks.reject_checks())).isEmpty()


def test_measures_grain_and_survey_coverage(built):
    results = checks.run_checks(built.fact_repair_orders, checks.fact_checks())
    assert {r.check_name: r.passed for r in results.collect()} == {
        "measures_valid": 1, "survey_coverage": 1, "fact_grain_unique": 1}


def test_checks_notice_bad_data(spark, built):
    bad = built.fact_repair_orders.limit(1).withColumn("total_amount", F.lit(1).cast("decimal(18,2)"))
    worse = built.fact_repair_orders.unionByName(bad)
    got = {r.check_name: r.passed for r in checks.run_checks(worse, checks.fact_checks()).collect()}
    assert got["measures_valid"] == 0 and got["fact_grain_unique"] == 0


def test_no_raw_contact_data(spark, built):
    assert checks.failed(checks.run_checks(built.dim_customer, checks.customer_checks())).isEmpty()
    audited = governance.pii_audit(built.tables()).collect()
    assert len(audited) == 7
    for row in audited:
        assert (row.raw_pii_columns, row.rows_with_email) == (0, 0), row.table_name
    for name, df in built.tables().items():
        assert governance.apply_access(df, name, "governance").columns == df.columns
        assert "raw_row" not in df.columns or governance.apply_access(
            df, name, "analyst", roles={"analyst": {"tables": "all", "pii": "none"}}).columns == ["ro_number", "reason"]
    leaky = {"dim_customer": built.dim_customer.withColumn("customer_email", F.lit("a@b"))}
    row = governance.pii_audit(leaky).first()
    assert row.raw_pii_columns == 1 and row.rows_with_email == 7


def test_customer_phone_is_the_first_seen_and_keys_follow_arrival(built):
    got = [(r.customer_key, r.phone_last4) for r in built.dim_customer.orderBy("customer_key").collect()]
    assert got == [(i + 1, f"{i:04d}") for i in range(7)]
    first = built.fact_repair_orders.orderBy("ro_key").select("ro_key", "ro_number").first()
    assert tuple(first) == (1, "RO000")


def test_the_last_survey_wins(built):
    # RO000..RO002 were asked twice.
    got = {r.ro_number: (r.satisfaction_score, r.would_recommend)
           for r in built.fact_repair_orders.collect()}
    assert got["RO000"] == (1 + 21 % 5, 0) and got["RO004"] == (5, 1)
    assert got["RO030"] == (None, None)


def test_an_empty_email_is_a_customer_of_its_own(spark, sources):
    orders = sources.orders.where("ro_number < 'RO010'").withColumn(
        "customer_email", F.when(F.col("ro_number") != "RO003", F.col("customer_email")))
    built = warehouse.build_warehouse(warehouse.Sources(
        orders, sources.vehicles, sources.dealers, sources.surveys))
    assert built.dim_customer.where("email_hash IS NULL").isEmpty()
    assert built.fact_repair_orders.where("customer_key IS NULL").isEmpty()
    assert built.fact_repair_orders.count() == 10


def test_the_built_tables_feed_the_retention_plans(built):
    history = retention.service_history(
        built.fact_repair_orders, built.dim_customer, built.dim_vehicle, built.dim_dealer, "2025-03-31", 3)
    rows = history.collect()
    assert rows and all(r.distance_to_dealer_mi is None for r in rows)
    assert {r.retained_next_period for r in rows} <= {0, 1}
    tiers = governance.retention_tiers(built.fact_repair_orders, "2025-12-31").collect()
    assert sum(r.ro_count for r in tiers) == 60


def test_unknown_dimension_members_can_fail_the_run(sources):
    with pytest.raises(ValueError):
        warehouse.build_warehouse(sources, on_orphan="fail")


def test_publish_switches_versions(spark, built, tmp_path):
    root = str(tmp_path / "published")
    layout.publish({"dim_dealer": built.dim_dealer}, root)
    assert layout.open_published(spark, root, "dim_dealer").count() == 3
    layout.publish({"dim_dealer": built.dim_dealer.limit(1)}, root)
    assert layout.open_published(spark, root, "dim_dealer").count() == 1


def test_raw_landing_keeps_text_and_origin(spark, files, tmp_path):
    bronze, kept = str(tmp_path / "bronze"), str(tmp_path / "kept")
    landing.land_raw(landing.read_dealers(spark, f"{files}/dealers.csv"), bronze, "dealers")
    rows = spark.read.parquet(bronze)
    assert rows.count() == 3 and dict(rows.dtypes)["service_bays"] == "string"
    assert rows.first()["source_file"].endswith("dealers.csv")
    assert landing.purge_raw(spark, bronze, kept, "2999-01-01").count() == 0
    assert landing.purge_raw(spark, bronze, kept + "2", "2020-01-01").count() == 3


def test_service_history_file_is_typed(spark, tmp_path):
    names = [f.name for f in schemas.HISTORY_CSV.fields]
    (tmp_path / "h.csv").write_text(",".join(names) + "\n" + ",".join(["1"] * len(names)))
    types = dict(landing.read_service_history(spark, str(tmp_path / "h.csv")).dtypes)
    assert types["in_warranty"] == "double" and types["region"] == "string"


def test_own_sql_runs_on_the_views(spark, built):
    names = views.create_views(built.tables(), "2025-12-31")
    try:
        got = views.rows(spark, """
            SELECT region, round(100.0 * sum(CASE WHEN repeat_repair_flag = 0 THEN 1 ELSE 0 END)
                   / count(*), 1) AS pct, count(*) AS n
            FROM fact_repair_orders JOIN dim_dealer USING (dealer_key)
            GROUP BY region ORDER BY region""").collect()
        library = kpis.fixed_first_visit(built.fact_repair_orders, built.dim_dealer)
        assert [tuple(r) for r in got] == [tuple(r) for r in library.orderBy("region").collect()]
        month = "SELECT sum(ro_count) FROM mv_monthly_dealer_revenue WHERE month = :m"
        assert views.scalar(spark, month, {"m": dt.date(2025, 1, 1)}) == 10
        assert views.scalar(
            spark, "SELECT sum(prior_visits) FROM v_customer_retention_features") == 60
        assert views.scalar(spark, "SELECT count(*) FROM v_dealer_performance") == 60
        assert set(names) <= {t.name for t in spark.catalog.listTables()}
    finally:
        for name in names:
            spark.catalog.dropTempView(name)
