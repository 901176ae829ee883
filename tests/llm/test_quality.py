import zlib

import cases
import numpy as np
import pytest

from bayline.llm import quality
from bayline.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_accuracy(spark, model):
    found = quality.score(table(spark, SF, "documents"), model).toPandas()
    assert len(found) == 1000 and found.score.between(0, 1).all()
    fold = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id])
    assert (found.held_out == fold).all() and (found.predicted == (found.score >= 0.3)).all()
    known = found.merge(table(spark, SF, "labels").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", __import__("pyspark").sql.functions.expr(
        "CASE WHEN pmod(crc32(cast(doc_id AS string)), 5) = 0 THEN 1 - quality ELSE quality END"))
    a, b = quality.fit(docs, labels, epochs=1), quality.fit(docs, turned, epochs=1)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_a_word_repeated_and_long_texts_score_like_their_parts():
    features = quality.Features()
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=1 << quality.BUCKET_BITS), 0.1)
    text = " ".join(f"word{i % 71}" for i in range(100_000))
    whole = model.scores([text, "", None], features)
    buckets, _ = features([text])
    logit = 0.1 + model.weights[buckets].sum() / (len(buckets) + quality.BLANK)
    assert abs(whole[0] - 1 / (1 + np.exp(-logit))) < 1e-9
    assert whole[1] == whole[2] == pytest.approx(1 / (1 + np.exp(-0.1)))
    again = features(["spam spam spam"])[0][:3]
    assert again[1] == again[2] != again[0]


def test_odd_rows(spark, model):
    docs = cases.frame(spark)
    found = quality.score(docs, model)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == len(cases.rows())
    by = {}
    for r in found.collect():
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[1] == by[2] and by[4] == by[5] == by[6] and len(set(by[9])) == 1
    kept = quality.accepted(docs, model)
    assert kept.schema == docs.schema and kept.count() == found.where("predicted = 1").count()
    assert quality.score(cases.empty(spark), model).count() == 0
    assert quality.accepted(cases.empty(spark), model).count() == 0


def test_odd_labels(spark):
    docs = cases.frame(spark)
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, text string")
    none = quality.fit(docs, labels([]))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    one = quality.fit(docs, labels([(1, 1, "x"), (3, 1, "x"), (None, 0, "x"), (7, None, "x"), (8, 9, "x")]))
    assert all(r.score > 0.5 for r in quality.score(docs, one).collect())
    both = quality.fit(docs, labels([(i, q, "x") for i in range(1, 13) for q in ((0, 1) if i in (3, 11, 12) else (1,))]))
    assert both.weights.any()
    quality.fit(cases.empty(spark), labels([(1, 1, "x"), (3, 0, "x")]))
