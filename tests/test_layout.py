import datetime as dt

import pytest
from pyspark.sql import functions as F

from bayline.operators import layout, nested
from bayline.plans import marts


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "fact")
    fact = spark.range(40_000).select(
        F.concat(F.lit("RO"), "id").alias("ro_number"),
        (F.pmod(F.xxhash64("id"), F.lit(60))).alias("dealer_key"),
        # Month 0 holds a third of the rows.
        F.add_months(F.lit("2024-01-01").cast("date"),
                     F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(18))).cast("int"))
        .alias("service_month"),
        F.lit("recall").alias("service_type"), F.lit(1).alias("total_amount"),
    )
    layout.write_partitioned(
        fact, path, "service_month", ["dealer_key", "service_type"], "ro_number", files=8)
    return path


def scan_metrics(df):
    """Files and rows the executed scan really touched."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = {}

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            m = node.metrics()
            found.update({k: m.apply(k).value() for k in ("numFiles", "numOutputRows", "numPartitions")})
        if name == "AdaptiveSparkPlanExec":
            visit(node.executedPlan())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
        if name.endswith("QueryStageExec"):
            visit(node.plan())

    visit(plan)
    return found


def test_a_month_filter_reads_only_its_folder(spark, stored):
    month = "2024-05-01"
    everything = scan_metrics(spark.read.parquet(stored))
    pruned = scan_metrics(layout.read_between(spark, stored, "service_month", month, month))
    assert everything["numPartitions"] == 18 and pruned["numPartitions"] == 1
    assert pruned["numOutputRows"] < 0.2 * everything["numOutputRows"]
    both = layout.read_between(spark, stored, "service_month", month, month).where("dealer_key = 7")
    text = both._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(dealer_key,7)" in text and "PartitionFilters: [isnotnull(service_month" in text
    benefit = marts.pruning_benefit(spark.read.parquet(stored), month, 7).first()
    assert benefit.scanned_partition_only < 0.2 * benefit.rows_total
    assert benefit.scanned_partition_plus_cluster < benefit.scanned_partition_only
    assert float(benefit.cost_reduction_vs_full_scan_pct) > 90


def test_a_hot_month_is_written_by_several_tasks(spark, stored):
    files = spark.read.parquet(stored).where("service_month = '2024-01-01'").select(
        F.input_file_name()).distinct().count()
    assert files > 1


def test_a_range_is_mandatory(spark, stored):
    with pytest.raises(ValueError):
        layout.read_between(spark, stored, "service_month", None, "2024-01-01")


def test_expiry_and_buckets(spark, stored):
    kept = layout.expire_partitions(
        spark.read.parquet(stored), "service_month", dt.date(2025, 6, 30), 100)
    assert {str(r.service_month) for r in kept.select("service_month").distinct().collect()} == {
        "2025-04-01", "2025-05-01", "2025-06-01"}
    keys = spark.createDataFrame([(20250101,), (20250315,), (20241231,), (20260101,)], "k int")
    got = keys.select(layout.range_bucket(F.col("k"), 20250101, 20260101, 100).alias("b")).collect()
    assert [r.b for r in got] == [0, 2, None, None]


def test_report_is_one_json_file(spark, tmp_path):
    layout.write_report(spark.createDataFrame([("a", None)], "k string, v int"), str(tmp_path / "r"))
    assert [p.read_text() for p in (tmp_path / "r").glob("*.json")] == ['{"k":"a","v":null}\n']


def test_oversized_orders_are_split_without_losing_lines(spark):
    lines = spark.range(5_000).select(
        F.when(F.col("id") < 2_000, "BIG").otherwise(F.concat(F.lit("R"), F.col("id") % 50))
        .alias("ro_number"),
        F.concat(F.lit("OP"), F.col("id") % 7).alias("op_code"), F.col("id").alias("n"),
    )
    built = nested.nest_lines(lines, ["ro_number"], ["op_code", "n"], [F.col("n")], max_lines=100)
    assert built.agg(F.max(F.size("line_items"))).first()[0] < 300
    assert built.where("ro_number = 'BIG'").count() > 10
    assert built.where("ro_number <> 'BIG' AND part_no <> 0").isEmpty()
    back = nested.unnest_lines(built, ["ro_number"])
    assert back.exceptAll(lines).isEmpty() and back.count() == 5_000
    items = built.where("ro_number = 'R1'").first().line_items
    assert items == sorted(items)


def test_tables_and_views_are_found_in_the_catalog(spark, stored, tmp_path):
    month = layout.read_between(spark, stored, "service_month", "2024-05-01", "2024-05-01")
    table = layout.create_table_as(month, "may_fact", str(tmp_path / "may"), "service_month")
    try:
        assert table.count() == month.count()
        month.select("dealer_key").createOrReplaceTempView("may_dealers")
        names = {t.name for t in spark.catalog.listTables()}
        assert {"may_fact", "may_dealers"} <= names
        assert spark.sql("SELECT count(*) FROM may_dealers").first()[0] == month.count()
    finally:
        spark.sql("DROP TABLE may_fact")
        spark.catalog.dropTempView("may_dealers")
