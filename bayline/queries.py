"""Every registered query: a name and a function of (session, data folder).

The functions only bind operators to the supplied tables. `plain` turns the result into types
that compare across engines: decimals become doubles, dates ISO text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bayline import schemas
from bayline.functions import money
from bayline.operators import audit, checks, digests, gates, history, joins, layout, nested, reconcile, zones
from bayline.operators.ranking import top_n_per_group
from bayline.plans import (
    churn, erasure, governance, incremental, kpis, lineage, mart_deltas, marts, metrics, outreach, reports, retention, views, warehouse,
)
from bayline.plans.star import Star, star
from bayline.session import COMPACT, scratch_path, shuffles_freed, stage
from bayline.sources import event_feed, landing, service_tables as src
from bayline.streaming import dedup, events as feed, sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Parameters of the registered queries; the oracle texts use the same values.
HISTORY_CUTOFF = "2000-12-31"
HISTORY_MONTHS = 2
SCAN_MONTH = "1998-03-01"
SCAN_DEALER = 7
BUCKET_START, BUCKET_END, BUCKET_STEP = 19950101, 20020101, 100
HISTORY_OPEN, HISTORY_CHANGE = "1995-01-01", "1998-07-01"
TABLE_MONTHS = "1996-02-01", "1996-07-01"
LOAD_DATES = "1994-06-01", "1997-01-01"
CHURN = churn.Settings()


def plain(df: DataFrame) -> DataFrame:
    def convert(field: T.StructField) -> F.Column:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        return col

    return df.select(*[convert(f) for f in df.schema.fields])


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register a function of the star under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(star(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# --- quality and audit -----------------------------------------------------------------------

@query
def dq_clean_orders(s: Star) -> DataFrame:
    return s.clean.drop("arrival")


@query
def dq_rejects(s: Star) -> DataFrame:
    return gates.quarantine(gates.gate_orders(s.raw_orders))


def _gated(s: Star) -> DataFrame:
    return gates.gate_orders(s.raw_orders)


def _audit(s: Star) -> DataFrame:
    sources = s.sources()
    orphans = warehouse.orphan_rejects(s.clean, s.dim_dealer, s.dim_vehicle)
    return audit.etl_audit(
        _gated(s), sources.vehicles, sources.dealers, sources.surveys, orphans, s.fact)


@query
def etl_audit(s: Star) -> DataFrame:
    return _audit(s).select("seq", "stage", "entity", "row_count").orderBy("seq")


@query
def etl_run_stats(s: Star) -> DataFrame:
    return audit.run_statistics(_gated(s))


@query
def audit_balance(s: Star) -> DataFrame:
    return audit.audit_balance(_audit(s))


def _staging(s: Star) -> DataFrame:
    parsed = feed.parse_events(
        event_feed.event_batch(s.spark, s.sf_dir), event_feed.FEED_TYPES + ("signup",))
    # All parsed events: what staging has no use for is dropped there.
    return marts.staging_service_events(parsed.select(*schemas.SERVICE_EVENT.fieldNames()))


def _feed_mart(events: DataFrame) -> DataFrame:
    return marts.monthly_dealer_revenue(
        events.withColumn("service_month", F.trunc("service_date", "month")))


@query
def dq_checks(s: Star) -> DataFrame:
    staging = _staging(s)
    # The checks of one table take a scan plus one aggregation per unique key: store it first.
    fact = stage(s.fact.select(
        "ro_number", "labor_amount", "parts_amount", "total_amount", "satisfaction_score"), "checked")
    return (
        checks.run_checks(fact, checks.fact_checks())
        .unionByName(checks.run_checks(s.dim_customer, checks.customer_checks()))
        .unionByName(checks.run_checks(gates.quarantine(_gated(s)), checks.reject_checks()))
        .unionByName(checks.run_checks(staging, checks.staging_checks(event_feed.FEED_TYPES)))
        .unionByName(checks.run_checks(_feed_mart(staging), checks.mart_checks()))
    )


def _dims(s: Star, stale: bool = False):
    dealer, vehicle = s.dim_dealer, s.dim_vehicle
    if stale:  # an old extract that lacks some members
        dealer = dealer.where(F.col("dealer_key") % 10 != 0)
        vehicle = vehicle.where(F.col("vehicle_key") % 50 != 0)
    # A calendar of the days on which orders were placed, which lacks some days of service.
    placed = src.table(s.spark, s.sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("open_date"))
    return [
        ("dealer", "dealer_key", dealer, "dealer_key"),
        ("vehicle", "vehicle_key", vehicle, "vehicle_key"),
        ("date", "open_date_key", warehouse.dim_date(placed), "date_key"),
    ]


@query
def orphan_fact_rows(s: Star) -> DataFrame:
    return joins.orphan_summary(s.fact, _dims(s))


@query
def orphan_fact_rows_stale_dims(s: Star) -> DataFrame:
    return joins.unresolved_keys(s.fact, _dims(s, stale=True))


def _order_versions(s: Star) -> tuple[DataFrame, DataFrame]:
    """Orders as they are, and a migrated copy with known differences."""
    key = F.col("o_orderkey")
    old = src.table(s.spark, s.sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
    )
    new = old.where(key % 50 != 7).select(
        "o_orderkey", "o_custkey",
        F.when(key % 20 == 3, F.lit(None)).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
        F.when(key % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
        .cast("decimal(18,2)").alias("o_totalprice"),
    )
    return old, new.unionByName(new.where(key % 100 == 1))


@query
def reconcile_datasets(s: Star) -> DataFrame:
    return reconcile.reconcile(
        *_order_versions(s), "o_orderkey", ["o_custkey", "o_orderpriority", "o_totalprice"],
        ["o_totalprice"],
    )


@query
def reconcile_differing_rows(s: Star) -> DataFrame:
    return reconcile.differing_rows(*_order_versions(s))


@query
def narrowed_difference(s: Star) -> DataFrame:
    """The same unlike rows, from the buckets whose digests differ."""
    return digests.narrowed_difference(*_order_versions(s), ["o_orderkey"])


@query
def profile_by_part(s: Star) -> DataFrame:
    """Records of the orders' parts by status, merged; distinct counts are estimates."""
    orders = src.table(s.spark, s.sf_dir, "orders").select("o_orderstatus", "o_orderpriority", "o_custkey")
    return digests.merged_profile(digests.profile_record(orders, "o_orderstatus")).drop("distinct_estimate")


@query
def profile_table(s: Star) -> DataFrame:
    return reconcile.profile(src.table(s.spark, s.sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    ))


# --- dimensions and fact ---------------------------------------------------------------------

@query
def dim_dealer(s: Star) -> DataFrame:
    return warehouse.dim_dealer(s.sources().dealers)


@query
def dim_vehicle(s: Star) -> DataFrame:
    return warehouse.dim_vehicle(s.sources().vehicles)


@query
def dim_customer(s: Star) -> DataFrame:
    return warehouse.dim_customer(gates.clean_orders(s.sources().orders))


@query
def dim_date(s: Star) -> DataFrame:
    return s.dim_date


@query
def fact_repair_orders(s: Star) -> DataFrame:
    sources = s.sources()
    clean = stage(gates.protect_contacts(gates.clean_orders(sources.orders).drop(gates.NEAR)), "clean", COMPACT)
    dealers, vehicles = warehouse.dim_dealer(sources.dealers), warehouse.dim_vehicle(sources.vehicles)
    resolved = warehouse.resolve_dimensions(clean, dealers, vehicles, warehouse.dim_customer(clean))
    orphans = stage(warehouse.resolved_orphans(resolved), "orphans")
    return warehouse.numbered_fact(clean, resolved, warehouse.order_keys(clean, orphans), sources.surveys)


def _landed(s: Star) -> warehouse.Sources:
    """The supplied tables as the files a source system would deliver, compressed, read back as such."""
    given, root = s.sources(), scratch_path(s.spark, "landing")
    orders = src.raw_orders(s.spark, s.sf_dir, contacts=True, in_order=True)
    surveys = src.surveys(s.spark, s.sf_dir, in_order=True)

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartitionByRange("arrival").sortWithinPartitions("arrival")

    with shuffles_freed(s.spark):
        for name, df, schema in (
            ("orders", orders, schemas.ORDERS_CSV), ("vehicles", in_order(given.vehicles), schemas.VEHICLES_CSV),
            ("dealers", in_order(given.dealers), schemas.DEALERS_CSV),
        ):
            df.select(*[F.col(c).cast("string") for c in schema.fieldNames()]).write.option(
                "header", True).csv(f"{root}/{name}", compression="gzip")
        surveys.drop("arrival").write.json(f"{root}/surveys", compression="gzip")
    return warehouse.Sources(
        landing.read_orders(s.spark, f"{root}/orders"), landing.read_vehicles(s.spark, f"{root}/vehicles"),
        landing.read_dealers(s.spark, f"{root}/dealers"),
        landing.read_surveys(s.spark, f"{root}/surveys", json_lines=True))


@query
def warehouse_from_files(s: Star) -> DataFrame:
    return warehouse.build_warehouse(_landed(s)).fact_repair_orders


def _load(s: Star, column: F.Column) -> F.Column:
    """The load that brings a row, by its date."""
    return F.when(column < LOAD_DATES[0], 1).when(column < LOAD_DATES[1], 2).otherwise(3)


def _loaded(s: Star) -> incremental.IncrementalWarehouse:
    """Three loads of orders by their dates, each with the dealers and vehicles known by then."""
    given = s.sources()
    orders = given.orders.withColumn("_load", _load(s, F.col("open_date")))
    stored = incremental.IncrementalWarehouse(scratch_path(s.spark, "loads"))
    stored.create(s.spark)
    for load in (1, 2, 3):
        known = [df.where(F.col("arrival") % 3 < load) for df in (given.dealers, given.vehicles)]
        stored.load(warehouse.Sources(
            orders=orders.where(F.col("_load") == load).drop("_load"), dealers=known[0], vehicles=known[1],
            surveys=given.surveys), load)
    return stored


@query
def keys_over_loads(s: Star) -> DataFrame:
    return _loaded(s).keys(s.spark)


@query
def fact_over_loads(s: Star) -> DataFrame:
    return _loaded(s).fact(s.spark)


@query
def rejects_over_loads(s: Star) -> DataFrame:
    return _loaded(s).rejects.read(s.spark).select("ro_number", "reason", "load")


@query
def raw_landing(s: Star) -> DataFrame:
    """Two extracts in the bronze area, with the file each row came from."""
    landed, bronze = _landed(s), scratch_path(s.spark, "bronze")
    landing.land_raw(landed.dealers, bronze, "dealers")
    landing.land_raw(landed.dealers.where("region = 'ASIA'"), bronze, "dealers_asia")
    stored = s.spark.read.parquet(bronze)
    return stored.select(
        "extract", "dealer_id", "dealer_name", F.col("source_file").contains("/dealers/").cast("int").alias("from_file"),
        F.col("ingested_at").isNotNull().cast("int").alias("has_time"))


@query
def published_refresh(s: Star) -> DataFrame:
    """A full refresh over an older one, asked by SQL through the views of the newest version."""
    root = scratch_path(s.spark, "published")
    tables = {"fact_repair_orders": s.settled_fact, "dim_dealer": s.dim_dealer, "dim_vehicle": s.dim_vehicle,
              "dim_customer": s.dim_customer}
    layout.publish({"fact_repair_orders": s.settled_fact.limit(10)}, root)
    layout.publish(tables, root)
    names = views.create_views({n: layout.open_published(s.spark, root, n) for n in tables}, src.AS_OF)
    try:
        return views.rows(s.spark, """
            SELECT d.region, f.pay_type, count(*) AS ro_count, sum(f.total_amount) AS total_amount
            FROM fact_repair_orders f JOIN dim_dealer d USING (dealer_key)
            WHERE f.service_type = :kind GROUP BY d.region, f.pay_type""", {"kind": "recall"})
    finally:
        for name in names:
            s.spark.catalog.dropTempView(name)


@query
def curated_table(s: Star) -> DataFrame:
    """The curated fact as a catalog table; a range of its months read back from its files."""
    path, name = scratch_path(s.spark, "curated"), f"curated_{uuid.uuid4().hex}"
    layout.create_table_as(marts.curated_fact(s.fact), name, path, "service_month")
    try:
        months = layout.read_between(s.spark, path, "service_month", *TABLE_MONTHS)
        return months.groupBy("service_month", "service_type").agg(
            F.count("*").alias("ro_count"), F.sum("total_amount").alias("total_amount"))
    finally:
        s.spark.sql(f"DROP TABLE {name}")


@query
def survey_flatten(s: Star) -> DataFrame:
    return warehouse.flatten_surveys(src.surveys(s.spark, s.sf_dir)).drop("arrival")


@query
def fact_survey_left_join(s: Star) -> DataFrame:
    return warehouse.with_survey(
        s.clean.select("ro_number"), src.surveys(s.spark, s.sf_dir))


@query
def staging_service_events(s: Star) -> DataFrame:
    return _staging(s)


@query
def curated_fact(s: Star) -> DataFrame:
    return stage(marts.curated_fact(s.fact), "curated")


# --- KPIs ------------------------------------------------------------------------------------

@query
def kpi_fixed_first_visit(s: Star) -> DataFrame:
    return kpis.fixed_first_visit(s.fact, s.dim_dealer)


@query
def kpi_dealer_csat_top10(s: Star) -> DataFrame:
    return kpis.dealer_csat_top(s.fact, s.dim_dealer)


@query
def kpi_pay_mix_by_month(s: Star) -> DataFrame:
    return kpis.pay_mix_by_month(s.fact, s.dim_date)


@query
def kpi_throughput_per_bay(s: Star) -> DataFrame:
    return kpis.throughput_per_bay(s.fact, s.dim_dealer)


@query
def kpi_csat_by_cycle_time(s: Star) -> DataFrame:
    return kpis.csat_by_cycle_time(s.fact)


@query
def kpi_recall_share(s: Star) -> DataFrame:
    return kpis.recall_share(s.fact, s.dim_vehicle)


@query
def kpi_headline(s: Star) -> DataFrame:
    return kpis.headline(s.fact)


@query
def dashboard_tiles(s: Star) -> DataFrame:
    # Every tile reads the fact, so it is stored once, with the columns the tiles need.
    fact = stage(s.fact.select(
        "dealer_key", "vehicle_key", "open_date_key", "service_date", "service_type", "pay_type",
        "days_to_close", "total_amount", "repeat_repair_flag", "satisfaction_score",
    ), "tiles")
    dates = warehouse.dim_date(fact, "service_date")
    return kpis.dashboard_tiles(fact, s.dim_dealer, s.dim_vehicle, dates)


# --- marts and layout ------------------------------------------------------------------------

@query
def mart_monthly_dealer_revenue(s: Star) -> DataFrame:
    return marts.monthly_dealer_revenue(s.fact)


@query
def mart_after_corrections(s: Star) -> DataFrame:
    """The mart after two loads of corrections: prices and dates that change, customers that go."""
    columns = ["ro_number", "service_date", "dealer_key", "total_amount", "satisfaction_score", "customer_key"]
    first = stage(s.fact.select(*columns), "orders")
    moved = F.pmod(F.col("dealer_key") * 7 + F.dayofmonth("service_date"), F.lit(10)) == 0
    second = first.withColumn("service_date", F.when(moved, F.add_months("service_date", 1)).otherwise(
        F.col("service_date"))).withColumn("total_amount", F.when(
            F.dayofmonth("service_date") == 3, F.col("total_amount") + 1).otherwise(F.col("total_amount")))
    gone = F.col("customer_key") % 10 == 0
    mart = mart_deltas.DeltaMart(scratch_path(s.spark, "mart"))
    mart.create(s.spark)
    mart.apply(None, first, 1)
    mart.apply(*mart_deltas.changes(first, second), 2)
    mart.apply(second.where(gone), None, 3)
    return mart.read(s.spark).withColumn("total_revenue", money(F.col("total_revenue")))


@query
def mart_top3(s: Star) -> DataFrame:
    return marts.top_mart_rows(marts.monthly_dealer_revenue(s.fact))


@query
def v_dealer_performance(s: Star) -> DataFrame:
    return marts.dealer_performance_view(s.fact)


def _stored_fact(s: Star) -> str:
    """The curated fact in its partitioned, sorted layout."""
    path = scratch_path(s.spark, "fact")
    layout.write_partitioned(
        marts.curated_fact(s.fact), path, "service_month", ["dealer_key", "service_type"],
        "ro_number",
    )
    return path


@query
def layout_roundtrip(s: Star) -> DataFrame:
    return layout.read_between(
        s.spark, _stored_fact(s), "service_month", "1996-01-01", "2000-12-01")


@query
def mart_layout_roundtrip(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "mart")
    layout.write_partitioned(
        marts.monthly_dealer_revenue(s.fact, rounded=False), path, "month", ["dealer_key"])
    return layout.read_between(s.spark, path, "month", "1995-01-01", "2001-12-01")


@query
def range_bucket_counts(s: Star) -> DataFrame:
    bucket = layout.range_bucket(
        F.col("open_date_key"), BUCKET_START, BUCKET_END, BUCKET_STEP)
    return s.fact.groupBy(bucket.cast("bigint").alias("bucket")).agg(
        F.count("*").alias("ro_count"), F.sum("total_amount").alias("total_amount"))


@query
def pruned_scan(s: Star) -> DataFrame:
    return s.spark.sql(
        "SELECT ro_number, dealer_key, service_date, service_type, total_amount FROM {fact} "
        "WHERE service_month = CAST(:month AS DATE) AND dealer_key = :dealer",
        args={"month": SCAN_MONTH, "dealer": SCAN_DEALER},
        fact=s.spark.read.parquet(_stored_fact(s)),
    )


@query
def pruning_benefit(s: Star) -> DataFrame:
    return marts.pruning_benefit(marts.curated_fact(s.fact), SCAN_MONTH, SCAN_DEALER)


@query
def scan_reduction(s: Star) -> DataFrame:
    """What three filters read of the fact under three layouts, by the files' own zone maps."""
    fact = stage(s.fact.select("ro_number", "dealer_key", "service_type", "service_date", "total_amount"), "laid_out")
    columns, files = ["service_date", "dealer_key", "service_type"], 32
    paths = {name: scratch_path(s.spark, name) for name in ("by_month", "sorted", "curve")}
    month = F.trunc("service_date", "month")
    fact.repartitionByRange(files, month).write.parquet(paths["by_month"])
    fact.repartitionByRange(files, month, "dealer_key", "service_type", F.xxhash64("ro_number")).sortWithinPartitions(
        month, "dealer_key", "service_type").write.parquet(paths["sorted"])
    zones.write_curve(fact, paths["curve"], columns, files)
    spans = {
        "month_and_dealer": {"service_date": (SCAN_MONTH, SCAN_MONTH[:8] + "31"), "dealer_key": (SCAN_DEALER, SCAN_DEALER)},
        "dealer": {"dealer_key": (SCAN_DEALER, SCAN_DEALER)},
        "dealer_and_type": {"dealer_key": (SCAN_DEALER, SCAN_DEALER), "service_type": ("recall", "recall")},
    }
    parts = []
    for layout_name, path in paths.items():
        found = stage(zones.zone_map(s.spark, path, columns), "zones")
        parts += [zones.touched(found, wanted).select(F.lit(layout_name).alias("layout"), F.lit(name).alias("asked"), "*")
                  for name, wanted in spans.items()]
    return reduce(DataFrame.unionByName, parts)


_ORDER = ["ro_number", "service_date", "dealer_key"]
_ITEM = ["op_code", "description", "labor_hours", "amount"]


def _nested(s: Star) -> DataFrame:
    return nested.nest_lines(
        src.order_lines(s.spark, s.sf_dir), _ORDER, _ITEM, [F.col("arrival")])


@query
def nested_lines_build(s: Star) -> DataFrame:
    items = F.col("line_items")
    text = F.transform(items, lambda i: F.concat_ws(
        ":", i["op_code"], i["description"], i["labor_hours"], i["amount"]))
    total = F.aggregate(
        items, F.lit(0).cast("decimal(28,2)"),
        lambda acc, i: (acc + i["amount"]).cast("decimal(28,2)"))
    return _nested(s).select(
        *_ORDER, "part_no", F.size(items).cast("bigint").alias("line_count"), total.alias("amount"),
        F.array_join(text, ",").alias("lines"),
    )


@query
def nested_lines_explode(s: Star) -> DataFrame:
    return nested.unnest_lines(stage(_nested(s), "nested"), _ORDER)


# --- retention -------------------------------------------------------------------------------

def _features(s: Star) -> DataFrame:
    return retention.retention_features(s.fact, s.dim_customer, s.dim_vehicle, src.AS_OF)


def _history(s: Star) -> DataFrame:
    return retention.service_history(
        s.fact, s.dim_customer, s.dim_vehicle, s.dim_dealer, HISTORY_CUTOFF, HISTORY_MONTHS,
        src.distance)


def _risk() -> F.Column:
    """A score both engines can compute, for the operators that take any score column."""
    d = lambda name: F.col(name).cast("double")
    score = (
        d("months_since_last_service") * 0.05 + d("repeat_repair_rate") * 0.4
        + (1 - d("customer_pay_share")) * 0.2
    )
    return F.round(F.least(F.lit(1.0), score), 6)


def _scored(s: Star) -> DataFrame:
    return _history(s).withColumn("churn_risk", _risk())


@query
def retention_features(s: Star) -> DataFrame:
    return _features(s)


@query
def customer_service_history(s: Star) -> DataFrame:
    return _history(s)


@query
def history_from_csv(s: Star) -> DataFrame:
    """The customer features as the file that a modelling team would get, read back."""
    path = scratch_path(s.spark, "history")
    _history(s).select(*[F.col(c).cast("string") for c in schemas.HISTORY_CSV.fieldNames()]).write.option(
        "header", True).csv(path)
    return landing.read_service_history(s.spark, path)


@query
def report_files(s: Star) -> DataFrame:
    """Two parts of the retention report, saved as JSON files and read back."""
    path, scored = scratch_path(s.spark, "report"), stage(_scored(s), "scored")
    parts = {"kpis": retention.retention_kpis(scored), "mix": outreach.action_mix(outreach.recommendations(scored))}
    reports.save_report(parts, path)
    found = {n: s.spark.read.schema(df.schema).json(f"{path}/{n}") for n, df in parts.items()}
    return found["kpis"].select(
        F.col("dimension").alias("part"), F.col("segment").alias("item"), "customers").unionByName(
        found["mix"].select(F.lit("action").alias("part"), F.col("recommended_action").alias("item"), "customers"))


@query
def retention_by_region(s: Star) -> DataFrame:
    return retention.retention_by_region(_history(s), s.dim_dealer)


@query
def retention_by_warranty(s: Star) -> DataFrame:
    return retention.retention_by_warranty(_history(s))


@query
def retention_kpis(s: Star) -> DataFrame:
    return retention.ordered_kpis(retention.retention_kpis(_history(s)))


@query
def at_risk_by_region(s: Star) -> DataFrame:
    scored = outreach.with_recommendation(_scored(s), outreach.default_actions())
    return outreach.at_risk_by_group(scored).select(
        "customer_key", "region", "churn_risk", "recommended_action", "expected_value")


@query
def at_risk_top_decile_by_region(s: Star) -> DataFrame:
    return outreach.at_risk_share_by_group(_scored(s)).select(
        "customer_key", "region", "churn_risk")


@query
def at_risk_by_model(s: Star) -> DataFrame:
    scored = _features(s).withColumn(
        "churn_risk", F.col("months_since_last_service") / F.lit(100.0))
    return top_n_per_group(
        scored, "model", [F.desc("churn_risk"), F.asc("customer_key"), F.asc("in_service_date")],
        "customer_key", 500,
    ).select("model", "customer_key", "in_service_date", "churn_risk")


@query
def at_risk_top_pct(s: Star) -> DataFrame:
    return outreach.at_risk(_scored(s).select("customer_key", "region", "churn_risk"))


@query
def outreach_action_mix(s: Star) -> DataFrame:
    return outreach.action_mix(outreach.recommendations(_scored(s)))


@query
def outreach_recommendations(s: Star) -> DataFrame:
    return outreach.report_head(outreach.recommendations(_scored(s)))


def _feature_score(s: Star) -> DataFrame:
    return _features(s).select(
        (F.col("months_since_last_service") / F.lit(100.0)).alias("score"), "had_recall")


@query
def metric_auc(s: Star) -> DataFrame:
    return metrics.roc_auc(_feature_score(s), "score", "had_recall")


@query
def metric_average_precision(s: Star) -> DataFrame:
    return metrics.average_precision(_feature_score(s), "score", "had_recall")


@query
def lift_at_k(s: Star) -> DataFrame:
    scored = _scored(s).withColumn("churned", 1 - F.col("retained_next_period"))
    return metrics.lift_at(scored, "churn_risk", "churned", "customer_key")


# --- churn model -----------------------------------------------------------------------------

def _churn(s: Star) -> churn.ChurnRun:
    return churn.run(stage(_history(s), "history"), CHURN)


@query
def churn_split_counts(s: Star) -> DataFrame:
    split = churn.stratified_split(churn.training_frame(_history(s)))
    return split.groupBy("churned", "is_train").agg(F.count("*").alias("customers"))


@query
def churn_metrics(s: Star) -> DataFrame:
    return churn.held_out_metrics(_churn(s).scored)


@query
def churn_split(s: Star) -> DataFrame:
    return churn.stratified_split(churn.training_frame(_history(s))).select(
        "customer_key", "region", "churned", "is_train")


@query
def churn_drivers(s: Star) -> DataFrame:
    """The features by their importance to the model."""
    return churn.drivers(s.spark, _churn(s).model)


@query
def churn_scores(s: Star) -> DataFrame:
    """Every customer's risk, with the label and whether the model was trained on it."""
    return _churn(s).scored.select("customer_key", "region", "churned", "is_train", "churn_risk")


@query
def at_risk_by_churn_model(s: Star) -> DataFrame:
    """The riskiest customers of each region by the model, with what to offer them."""
    return outreach.at_risk_by_group(outreach.with_recommendation(
        stage(_churn(s).scored, "scored"), outreach.default_actions())).select(
        "customer_key", "region", "churn_risk", "recommended_action", "expected_value")


# --- governance ------------------------------------------------------------------------------

@query
def erase_customers(s: Star) -> DataFrame:
    requests = s.dim_customer.where(F.col("consent_status") == "ccpa_opt_out")
    return governance.erase_customers(s.dim_customer, requests).drop("nation_key")


@query
def erase_from_files(s: Star) -> DataFrame:
    """The customers that are left after an erasure that rewrites only the files concerned."""
    customers = s.dim_customer.drop("nation_key").withColumn("customer_key", F.col("customer_key").cast("long"))
    table = erasure.ErasableTable(scratch_path(s.spark, "erasable"), customers.schema, "email_hash")
    table.create(customers.repartitionByRange(16, "customer_key"))
    table.erase(customers.where((F.col("consent_status") == "ccpa_opt_out") & (F.col("customer_key") % 5 == 0)))
    return table.read(s.spark)


@query
def retention_tiering(s: Star) -> DataFrame:
    return governance.retention_tiers(s.fact, src.AS_OF)


@query
def expire_partitions(s: Star) -> DataFrame:
    stored = s.spark.read.parquet(_stored_fact(s))
    return layout.expire_partitions(stored, "service_month", "2004-12-31")


@query
def external_share_extract(s: Star) -> DataFrame:
    return governance.external_share(s.fact, s.dim_customer).select(
        "ro_number", "customer_key", "service_date", "service_type", "total_amount")


@query
def access_analyst_view(s: Star) -> DataFrame:
    return governance.apply_access(s.dim_vehicle, "dim_vehicle", "analyst")


@query
def scd2_dealer(s: Star) -> DataFrame:
    attributes = ["dealer_name", "region", "service_bays"]
    key = F.col("dealer_key")
    first = s.dim_dealer.select("dealer_key", *attributes)
    grown = F.when(key % 10 == 0, F.col("service_bays") + 1).otherwise(F.col("service_bays"))
    second = first.where(key % 25 != 7).withColumn("service_bays", grown.cast("int"))
    opened = first.where(key % 50 == 3).withColumn("dealer_key", key + 1_000_000_000)
    changed = history.apply_changes(
        history.open_history(first, HISTORY_OPEN), second.unionByName(opened), "dealer_key",
        attributes, HISTORY_CHANGE,
    )
    return changed.withColumn("is_current", F.col("is_current").cast("int"))


def _catalogued(s: Star) -> dict[str, DataFrame]:
    return {
        "fact_repair_orders": s.fact.select(
            "ro_number", "dealer_key", "vehicle_key", "customer_key", "service_type", "pay_type",
            "total_amount"),
        "dim_customer": s.dim_customer.drop("nation_key"),
        "dim_vehicle": s.dim_vehicle,
        "dim_dealer": s.dim_dealer.drop("nation_key"),
    }


@query
def catalog_pii_audit(s: Star) -> DataFrame:
    """Over every table of the warehouse, as the session's catalog knows them."""
    built = warehouse.build_warehouse(s.sources()).tables()
    prefix = f"audited_{uuid.uuid4().hex}_"
    names = {name: prefix + name for name in built}
    for name, df in built.items():
        df.createOrReplaceTempView(names[name])
    try:
        found = governance.pii_audit_of_catalog(s.spark, names.values())
    finally:
        for view in names.values():
            s.spark.catalog.dropTempView(view)
    return found.withColumn("table_name", F.substring("table_name", len(prefix) + 1, 100))


@query
def catalog_conformance(s: Star) -> DataFrame:
    return governance.catalog_conformance(_catalogued(s))


@query
def catalog_derived_labels(s: Star) -> DataFrame:
    """Declared labels beside those that follow from the names of customers in the source tables."""
    return lineage.derived_conformance(_catalogued(s), by_name={"c_name": "PII_DIRECT", "p_partkey": "PII_INDIRECT"})


# --- streaming -------------------------------------------------------------------------------

def _routed(s: Star) -> tuple[str, str]:
    """Run the event feed through the router; paths of the accepted and the refused events."""
    good, bad, state = (scratch_path(s.spark, n) for n in ("events", "dead", "state"))
    sinks.create_target(s.spark, good, schemas.SERVICE_EVENT)
    sinks.create_target(s.spark, bad, schemas.DEAD_LETTER)
    sinks.run_available(sinks.route_events(
        event_feed.event_stream(s.spark, s.sf_dir), good, state, bad, event_feed.FEED_TYPES))
    return good, bad


@query
def stream_valid_events(s: Star) -> DataFrame:
    return sinks.read_target(s.spark, _routed(s)[0])


@query
def stream_dead_letter(s: Star) -> DataFrame:
    return sinks.read_target(s.spark, _routed(s)[1])


def _accepted_stream(s: Star) -> DataFrame:
    return feed.valid_events(feed.parse_events(
        event_feed.event_stream(s.spark, s.sf_dir), event_feed.FEED_TYPES, keep=["ts"]), keep=["ts"])


def _delivered_again(s: Star) -> str:
    """The feed as files, and then every third message once more, whatever its time.

    As many files as tasks can write at once, so that no task's share is a third of the feed.
    """
    path, tasks = scratch_path(s.spark, "deliveries"), s.spark.sparkContext.defaultParallelism
    once = event_feed.event_batch(s.spark, s.sf_dir)
    once.repartitionByRange(max(3, tasks), "ts").write.parquet(path)
    event_feed.redelivered(once).repartition(max(2, tasks)).write.mode("append").parquet(path)
    return path


@query
def stream_dedup(s: Star) -> DataFrame:
    out, keys, state = (scratch_path(s.spark, n) for n in ("unique", "keys", "state"))
    log = dedup.KeyLog(keys)
    sinks.create_target(s.spark, out, schemas.SERVICE_EVENT)
    log.create(s.spark)
    path = _delivered_again(s)
    files = len(s.spark.read.schema("value binary, ts timestamp").parquet(path).inputFiles())
    # Three micro-batches, or a few more: each of them has fixed costs.
    stream = s.spark.readStream.schema("value binary, ts timestamp").option(
        "maxFilesPerTrigger", max(2, -(-files // 3))).parquet(path)
    accepted = feed.valid_events(feed.parse_events(stream, event_feed.FEED_TYPES))
    sinks.run_available(dedup.unique_sink(accepted, out, log, state))
    return sinks.read_target(s.spark, out, schemas.SERVICE_EVENT)


@query
def stream_monthly_mart(s: Star) -> DataFrame:
    out, state = scratch_path(s.spark, "mart"), scratch_path(s.spark, "state")
    sinks.create_target(s.spark, out, schemas.MONTHLY_MART)
    sinks.run_available(sinks.monthly_mart(_accepted_stream(s), out, state))
    return sinks.read_monthly_mart(s.spark, out).select(
        "month", "dealer_key", "ro_count", money(F.col("total_revenue")).alias("total_revenue"),
        "score_sum", "score_count",
    )
