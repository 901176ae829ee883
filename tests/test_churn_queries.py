import os
import shutil

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from conftest import DATA

from bayline import queries
from bayline.plans import churn, outreach
from bayline.plans.star import star

# The definitions in SQL, over stored scores.
METRICS = """
WITH test AS (SELECT * FROM read_parquet('{0}/*.parquet') WHERE is_train = 0),
pairs AS (
  SELECT avg(CASE WHEN p.churn_risk > n.churn_risk THEN 1.0 WHEN p.churn_risk = n.churn_risk THEN 0.5 ELSE 0 END) AS auc
  FROM test p JOIN test n ON p.churned = 1 AND n.churned = 0),
steps AS (
  SELECT churn_risk, sum(churned) AS hits, count(*) AS n FROM test GROUP BY churn_risk),
curve AS (
  SELECT hits, sum(hits) OVER w AS found, sum(n) OVER w AS seen FROM steps WINDOW w AS (ORDER BY churn_risk DESC)),
best AS (
  SELECT churned FROM test
  QUALIFY row_number() OVER (ORDER BY churn_risk DESC, customer_key) <= greatest(1, (SELECT count(*) FROM test) // 10))
SELECT round((SELECT auc FROM pairs), 4),
  round((SELECT sum(hits * found / seen) / (SELECT sum(churned) FROM test) FROM curve), 4),
  round((SELECT avg(churned) FROM best) / (SELECT avg(churned) FROM test), 2)
"""


@pytest.fixture(scope="module")
def scores(spark, tmp_path_factory):
    """The scores of one run, stored."""
    path = str(tmp_path_factory.mktemp("scores") / "scores")
    run = churn.run(queries.stage(queries._history(star(spark, f"{DATA}/sf0.01")), "history"), churn.Settings(trees=10))
    run.scored.write.parquet(path)
    return run, spark.read.parquet(path), path


def test_metrics_are_what_sql_finds_in_the_stored_scores(scores):
    _, stored, path = scores
    want = duckdb.connect().execute(METRICS.format(path)).fetchone()
    got = churn.held_out_metrics(stored).first()
    assert [got.churn_roc_auc, got.churn_pr_auc, got.lift_at_10pct] == pytest.approx([float(w) for w in want], abs=2e-4)


def test_shuffled_scores_have_other_metrics_and_another_list(scores):
    _, stored, _ = scores
    numbered = [r.churn_risk for r in stored.orderBy(F.md5(F.col("customer_key").cast("string"))).collect()]
    risk = dict(zip([r.customer_key for r in stored.orderBy("customer_key").collect()], numbered))
    shuffled = stored.drop("churn_risk").join(
        stored.sparkSession.createDataFrame(list(risk.items()), "customer_key long, churn_risk double"), "customer_key")
    # On the rows it was trained on, the model knows far more than chance.
    known = [df.withColumn("is_train", 1 - F.col("is_train")) for df in (stored, shuffled)]
    true, false = (churn.held_out_metrics(df).first() for df in known)
    assert true.churn_roc_auc > 0.6 > false.churn_roc_auc + 0.03
    assert true.lift_at_10pct > false.lift_at_10pct + 0.1
    lists = [{r.customer_key for r in outreach.at_risk(df, 0.1).collect()} for df in (stored, shuffled)]
    assert len(lists[0]) == len(lists[1]) and len(lists[0] & lists[1]) < len(lists[0]) / 2


def test_queries_return_the_models_results(spark, monkeypatch):
    monkeypatch.setattr(queries, "CHURN", churn.Settings(trees=5))
    ask = lambda name: queries.QUERIES[name](spark, f"{DATA}/sf0.001")
    drivers = ask("churn_drivers").collect()
    weights = [r.importance for r in drivers]
    assert weights == sorted(weights, reverse=True) and len(set(weights)) > 3 and abs(sum(weights) - 1) < 1e-3
    scored = {r.customer_key: r for r in ask("churn_scores").collect()}
    risks = [r.churn_risk for r in scored.values()]
    assert all(0 <= r <= 1 for r in risks) and len(set(risks)) > 10
    listed = ask("at_risk_by_churn_model").collect()
    by_region = {}
    for r in listed:
        assert r.churn_risk == scored[r.customer_key].churn_risk and r.recommended_action
        by_region.setdefault(r.region, set()).add(r.customer_key)
    for region, keys in by_region.items():
        best = sorted((r for r in scored.values() if r.region == region), key=lambda r: (-r.churn_risk, r.customer_key))
        assert keys == {r.customer_key for r in best[:500]}


def test_each_call_trains_on_the_tables_as_they_are(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "CHURN", churn.Settings(trees=2))
    for name in os.listdir(f"{DATA}/sf0.001"):
        shutil.copyfile(f"{DATA}/sf0.001/{name}", tmp_path / name)

    def customers():
        rows = queries.QUERIES["churn_scores"](spark, str(tmp_path)).collect()
        return {r.customer_key for r in rows}

    before = customers()
    gone = set(sorted(before)[::2])
    orders = pq.read_table(f"{DATA}/sf0.001/orders.parquet")
    left = pc.invert(pc.is_in(orders["o_custkey"], pa.array(sorted(gone), pa.int64())))
    pq.write_table(orders.filter(left), tmp_path / "orders.parquet")
    assert gone and customers() == before - gone
