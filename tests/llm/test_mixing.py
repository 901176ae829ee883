import sys

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from oracle_compare import compare, connect  # noqa: E402

from bayline.llm import mixing, oracle  # noqa: E402
from bayline.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_matches_sql(spark):
    assert compare(mixing.mixture(table(spark, SF, "documents")), connect(SF), oracle.MIX) is None


@pytest.fixture(scope="module")
def sources(spark):
    """Four sources of very different size, ten words to a document."""
    return spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('word ', 10)").alias("text"),
        F.expr("CASE WHEN id < 3000 THEN 'a' WHEN id < 3700 THEN 'b' WHEN id < 3950 THEN 'c' ELSE 'd' END").alias("source"))


def shares(df):
    got = {r.source: r.n for r in df.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    return got, np.array([got[s] for s in sorted(got)]) / sum(got.values())


def test_the_repetition_limit_holds_and_nothing_is_lost(sources):
    mix = mixing.mixture(sources, max_repeats=3.0).cache()
    assert mix.select("doc_id").distinct().count() == 4000
    per_doc = mix.groupBy("source", "doc_id").agg(F.count("*").alias("n"))
    got = {r.source: (r.low, r.high) for r in per_doc.groupBy("source").agg(
        F.min("n").alias("low"), F.max("n").alias("high")).collect()}
    # The exponent is rounded so that the limit isn't passed: the last block may lack a document.
    assert got["a"] == (1, 1) and got["d"][1] == 3 and mix.where("source = 'd'").count() in (149, 150)
    # Weights are shares to one power.
    tokens, _ = shares(mix)
    t = 1 - np.log(3) / np.log(60)
    want = np.array([3000, 700, 250, 50.0]) ** t
    have = np.array([tokens[s] for s in "abcd"])
    assert np.allclose(have / have[0], want / want[0], rtol=0.02)


def test_the_entropy_target_is_met_within_the_budget(sources):
    mix = mixing.mixture(sources, target_entropy=0.9, budget=20_000)
    tokens, p = shares(mix)
    assert sum(tokens.values()) <= 20_000 and sum(tokens.values()) > 19_900
    assert abs(-(p * np.log(p)).sum() / np.log(4) - 0.9) < 0.005
    with pytest.raises(ValueError):
        mixing.mixture(sources, target_entropy=0.9, max_repeats=2.0)


def test_any_beginning_has_about_the_target_weights(sources):
    mix = mixing.mixture(sources, max_repeats=3.0)
    _, whole = shares(mix)
    _, first = shares(mix.where("place < 0.25"))
    assert np.abs(whole - first).max() < 0.05


def test_odd_rows(spark):
    docs = cases.frame(spark)
    mix = mixing.mixed(docs)
    assert mix.schema == docs.schema
    for r in docs.select("doc_id", "key").collect():
        assert mix.where(F.col("key") == r.key).count() in (1, 2)
    assert mixing.mixed(cases.empty(spark)).count() == 0
    assert mixing.mixture(cases.empty(spark)).columns == ["doc_id", "source", "n_tokens", "epoch", "place"]
    silent = docs.where("text IS NULL OR trim(text) = ''")
    assert mixing.mixed(silent).count() == silent.count()
