"""Properties of the executed plans that decide how a query scales."""

import pytest
from conftest import DATA
from oracle_compare import row_work_outside_the_jvm_or_pairwise
from pyspark.sql import functions as F

from bayline.operators import gates
from bayline.queries import QUERIES
from bayline.sources import service_tables

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Every other query is checked for the same in test_oracle.
@pytest.mark.parametrize("name", [
    "dq_rejects", "etl_run_stats", "kpi_dealer_csat_top10", "retention_features",
    "customer_service_history", "metric_auc", "orphan_fact_rows", "reconcile_datasets",
])
def test_no_python_rows_no_cross_joins(spark, no_broadcast, name):
    assert row_work_outside_the_jvm_or_pairwise(QUERIES[name](spark, SF_DIR)) == []


def test_kpis_do_not_join_the_surveys_they_do_not_use(spark, no_broadcast):
    text = plan(QUERIES["kpi_fixed_first_visit"](spark, SF_DIR))
    assert text.count("l_orderkey") and "max_by" not in text
    # Orders are cut to one row per number before the shuffle, and counted before the join.
    partial, exchange = text.index(", Partial"), text.index("Exchange hashpartitioning(_w0")
    assert exchange < partial
    dealer_join = text.index("SortMergeJoin [dealer_key")
    assert text.index("partial_count(1)") > dealer_join


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(QUERIES["kpi_fixed_first_visit"](spark, SF_DIR))
    orders = next(line for line in text.splitlines() if "FileScan" in line and "o_orderkey" in line)
    assert "o_totalprice" not in orders and "o_custkey" not in orders


def test_filters_reach_the_stored_fact(spark):
    text = plan(QUERIES["pruned_scan"](spark, SF_DIR))
    assert "PartitionFilters: [isnotnull(service_month" in text
    assert "EqualTo(dealer_key,7)" in text


def test_top_n_is_cut_before_the_shuffle(spark, no_broadcast):
    text = plan(QUERIES["at_risk_by_model"](spark, SF_DIR))
    assert text.count("row_number(), 500, Partial") == 2


@pytest.fixture
def small_skew_limits(spark):
    """Limits at which the test's few rows count as skewed."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adaptive_execution_splits_a_skewed_lookup(spark, no_broadcast, small_skew_limits):
    """A vehicle that owns a third of the orders: Spark splits its join partition."""
    facts = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("vehicle_key"), "id")
    dims = spark.range(0, 60_000, 1, 16).select(F.col("id").alias("vehicle_key"))
    joined = facts.join(dims, "vehicle_key", "left").groupBy("id").count()
    joined.collect()
    assert "skew=true" in plan(joined)


def test_the_base_join_splits_a_hot_order(spark, no_broadcast, small_skew_limits, tmp_path):
    """One order owns a third of the lines of the registered queries' base join."""
    folder = str(tmp_path)
    lines = service_tables.table(spark, f"{DATA}/sf0.01", "lineitem")
    hot = lines.withColumn("l_orderkey", F.when(F.xxhash64("l_partkey", "l_shipdate") % 3 == 0, F.lit(1))
                           .otherwise(F.col("l_orderkey")).cast("bigint"))
    hot.repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    service_tables.table(spark, f"{DATA}/sf0.01", "orders").repartition(8).write.parquet(f"{folder}/orders.parquet")
    clean = gates.clean_orders(service_tables.raw_orders(spark, folder))
    clean.collect()
    text = plan(clean)
    assert "REPARTITION_BY_NUM" not in text and "skew=true" in text
