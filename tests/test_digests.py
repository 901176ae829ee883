"""Digests find every unlike row and read few others."""

import pytest
from pyspark.sql import functions as F

from bayline.operators import digests, reconcile


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("k"), (F.col("id") % 97).cast("string").alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 1.5).alias("b"))
    return df.unionByName(df.where("k % 1000 = 1")).repartition(7)


def found(df):
    return sorted(map(str, df.collect()))


def test_equal_tables_shuffle_no_rows(spark, table):
    again = table.repartition(3).orderBy("a")
    assert digests.narrowed_difference(table, again, ["k"]).isEmpty()
    plan = digests.digest(table, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1 and "Exchange hashpartitioning(bucket" in plan


@pytest.mark.parametrize("name, change", [
    ("changed value", lambda df: df.withColumn("a", F.when(F.col("k") % 7001 == 3, "x").otherwise(F.col("a")))),
    ("null for a value", lambda df: df.withColumn("b", F.when(F.col("k") != 77, F.col("b")))),
    ("missing rows", lambda df: df.where("k not in (5, 1001)")),
    ("a copy more", lambda df: df.unionByName(df.where("k = 9"))),
    ("values swapped", lambda df: df.withColumn("a", F.when(F.col("k") == 1, "2").when(F.col("k") == 2, "1").otherwise(F.col("a")))),
    ("nothing left", lambda df: df.where("false")),
])
def test_unlike_rows_are_all_found(table, name, change):
    other = change(table)
    assert found(digests.narrowed_difference(table, other, ["k"])) == found(reconcile.differing_rows(table, other)) != []


def test_only_unlike_buckets_are_read(spark, table):
    other = table.where("k <> 123")
    left, right = digests.digest(table, ["k"]), digests.digest(other, ["k"])
    buckets = digests.unlike_buckets(left, right)
    assert len(buckets) == 1
    kept = digests.narrowed_difference(table, other, ["k"], stored=left)
    assert [r.k for r in kept.collect()] == [123]


def test_records_of_parts_merge_to_the_profile(table):
    parts = table.withColumn("part", F.col("k") % 4)
    whole = {r.column_name: r for r in digests.merged_profile(digests.profile_record(parts, "part")).collect()}
    exact = {r.column_name: r for r in reconcile.profile(table).collect()}
    for c in ("k", "a", "b"):
        one, other = ((r.row_count, r.null_count, r.min_value, r.max_value) for r in (whole[c], exact[c]))
        assert one == other
        assert abs(whole[c].distinct_estimate - exact[c].distinct_count) < 0.1 * exact[c].distinct_count
