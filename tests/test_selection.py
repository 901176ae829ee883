"""The best rows by narrowing histograms against a plain sort."""

import math
import random

import pytest
from pyspark.sql import functions as F

from bayline.operators import selection

NAN, INF = float("nan"), float("inf")


def best(rows, n):
    def place(r):
        s = r[1]
        kind = 4 if s is None else 0 if math.isnan(s) else 1 if s == INF else 3 if s == -INF else 2
        return kind, -s if kind == 2 else 0, (0, 0) if r[0] is None else (1, r[0])
    return sorted(rows, key=place)[:n]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, score double").repartition(4)


RNG = random.Random(11)
SHAPES = {
    "even": [(i, RNG.random()) for i in range(2000)],
    "ties": [(i, 0.5 if i % 3 == 0 else round(RNG.random(), 1)) for i in range(2000)],
    "one value": [(i, 1.25) for i in range(2000)],
    "long tail": [(i, math.exp(RNG.gauss(0, 8))) for i in range(2000)],
    "odd": [(i, [NAN, INF, -INF, None, 1e308, -1e308, 5e-324, 0.0][i % 8]) for i in range(2000)] + [(None, 0.0)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_the_same_rows_as_a_sort(spark, shape):
    rows = SHAPES[shape]
    df = frame(spark, rows)
    for fraction in (0.0004, 0.15, 0.5, 0.93):
        got = selection.best_fraction(df, fraction, "score", "k", at_least=1, few=20)
        want = best(rows, max(1, int(len(rows) * fraction)))
        assert sorted(str(r[0]) for r in got.collect()) == sorted(str(r[0]) for r in want)


def test_none_and_all(spark):
    df = frame(spark, SHAPES["odd"])
    assert selection.best_fraction(df, 0.0, "score", "k").count() == 0
    assert selection.best_fraction(df, 1.0, "score", "k").count() == len(SHAPES["odd"])
    assert selection.best_fraction(df.limit(0), 0.5, "score", "k", at_least=3).count() == 0


def test_decimal_scores_and_text_keys(spark):
    df = spark.range(500).select(
        F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("k"),
        (F.col("id") % 50).cast("decimal(10,2)").alias("score"))
    got = selection.best_fraction(df, 0.05, "score", "k", few=5)
    assert sorted(r.k for r in got.collect()) == sorted(
        [f"k{i:04}" for i in range(49, 500, 50)] + [f"k{i:04}" for i in range(48, 500, 50)]
        + [f"k{i:04}" for i in range(47, 250, 50)])


def test_the_table_is_filtered_only(spark):
    """No exchange of the table's rows; the sort has only what lies in the last step."""
    df = frame(spark, SHAPES["even"]).withColumn("wide", F.lit("x"))
    plan = selection.best_fraction(df, 0.15, "score", "k", few=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and "RepartitionByExpression [score" not in plan
