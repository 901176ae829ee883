import random

import pytest
from pyspark.sql import functions as F

from bayline.operators import ranking
from bayline.plans import metrics


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    # A third of the rows share one score, and one group holds most rows.
    rows = [
        (i, 0.5 if i % 3 == 0 else round(rng.random(), 2), "hot" if i % 4 else f"g{i % 12}",
         int(rng.random() < 0.4))
        for i in range(3_000)
    ]
    return rows, spark.createDataFrame(rows, "k bigint, score double, grp string, y int").repartition(5)


def order():
    return [F.desc("score"), F.asc("k")]


def test_positions_equal_a_global_sort(scored):
    rows, df = scored
    expected = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    got = {r.k: r.position for r in ranking.with_position(df, order()).collect()}
    assert got == expected


def test_surrogate_keys_start_at_one_and_have_no_gaps(scored):
    rows, df = scored
    keyed = ranking.with_surrogate_key(df, [F.asc("k")], "sk")
    assert keyed.columns[0] == "sk"
    assert all(r.sk == r.k + 1 for r in keyed.collect())


@pytest.mark.parametrize("fraction, at_least, expected", [
    (0.15, 0, 450), (0.0001, 1, 1), (0.0, 0, 0), (1.0, 0, 3000)])
def test_top_fraction(scored, fraction, at_least, expected):
    rows, df = scored
    want = [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))[:expected]]
    got = ranking.top_fraction(df, order(), fraction, at_least).collect()
    assert sorted(r.k for r in got) == sorted(want)


def test_top_n_per_group_is_exact_with_a_hot_group(scored):
    rows, df = scored
    want = set()
    for g in {r[2] for r in rows}:
        mine = sorted((r for r in rows if r[2] == g), key=lambda r: (-r[1], r[0]))
        want |= {r[0] for r in mine[:20]}
    got = ranking.top_n_per_group(df, "grp", order(), "k", 20, salts=4)
    assert {r.k for r in got.collect()} == want
    assert got.columns == df.columns


def test_running_totals(scored):
    rows, df = scored
    got = ranking.with_running_totals(df.select("k", "y"), [F.asc("k")], ["y"]).collect()
    total, expected = 0, {}
    for r in sorted(rows):
        expected[r[0]] = total
        total += r[3]
    assert {r.k: r.y_before for r in got} == expected


def brute_auc(rows):
    pos = [s for _, s, _, y in rows if y]
    neg = [s for _, s, _, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    total, seen, hits, area = sum(r[3] for r in rows), 0, 0, 0.0
    for s in sorted({r[1] for r in rows}, reverse=True):
        group = [r for r in rows if r[1] == s]
        pos = sum(r[3] for r in group)
        seen, hits = seen + len(group), hits + pos
        area += pos / total * hits / seen
    return area


def test_metrics_equal_their_definitions(scored):
    rows, df = scored
    got = metrics.curve_metrics(metrics.score_curve(df, "score", "y")).first()
    assert got.roc_auc == pytest.approx(brute_auc(rows), abs=1e-6)
    assert got.average_precision == pytest.approx(brute_ap(rows), abs=1e-6)
    top = sorted(rows, key=lambda r: (-r[1], r[0]))[:300]
    lift = metrics.lift_at(df, "score", "y", "k").first()
    expected = (sum(r[3] for r in top) / 300) / (sum(r[3] for r in rows) / 3000)
    assert (lift.targeted, lift.lift) == (300, pytest.approx(expected, abs=1e-6))


def test_metrics_without_positives_are_null(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (2, 0.2, 0)], "k bigint, score double, y int")
    got = metrics.curve_metrics(metrics.score_curve(df, "score", "y")).first()
    assert got.roc_auc is None and got.average_precision is None
