import math
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from bayline.llm import lm_scoring
from bayline.llm.common import table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w] + [None]


def check(found, rows):
    """Exact columns against counting; returns model and exact bigram scores of the held-out rows."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    single, double, starts = Counter(), Counter(), 0
    for i, t in rows:
        if not held(i):
            w = tokens(t)
            single.update(w)
            double.update(zip(["<s>", *w], w))
            starts += 1
    n, v = sum(single.values()), len(single)

    def exact(w):
        total = 0.0
        for a, b in zip(["<s>", *w], w):
            before = starts if a == "<s>" else single[a]
            total += math.log10((double[a, b] / max(before, 1) + (single[b] + 1) / (n + v + 1)) / 2)
        return total

    want = sorted((-1 if i is None else i, held(i), len(w := tokens(t)), sum(single[x] > 0 for x in w), n,
                   sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w), exact(w)) for i, t in rows)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                  r.base_score, r.score) for r in found.collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
    return [(g[6], w[6], w[2]) for g, w in zip(got, want) if w[1]]


def test_whole_table_against_counting(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    scored = check(lm_scoring.scores(docs), [(r.doc_id, r.text) for r in docs.collect()])
    # Quantised counts and false positives move the score of a token a little.
    assert abs(sum(g - w for g, w, _ in scored)) / sum(n for *_, n in scored) < 0.1


def test_several_blocks_give_the_same(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    whole = {r.doc_id: r for r in lm_scoring.scores(docs).collect()}
    monkeypatch.setattr(lm_scoring, "BLOCK", 5_000)
    for r in lm_scoring.scores(docs).collect():
        assert r[:5] == whole[r.doc_id][:5]
        assert (r.base_score, r.score) == pytest.approx((whole[r.doc_id].base_score, whole[r.doc_id].score), rel=1e-12)


def test_the_filter_never_tells_too_little():
    rng = np.random.default_rng(2)
    hashes = np.sort(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    counts = rng.geometric(0.2, 20_000).astype(np.int64)
    found = lm_scoring.Segment(lm_scoring.segment(hashes, counts))
    levels = found.levels(hashes)
    assert (levels >= lm_scoring.levels_of(counts)).all() and (levels == lm_scoring.levels_of(counts)).mean() > 0.9
    others = found.levels(rng.integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64))
    assert (others > 0).mean() < 0.05
    assert lm_scoring.middle(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


def test_a_segment_grows_with_its_entries():
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 50_000, dtype=np.uint64))
    sizes = [8 * len(lm_scoring.segment(hashes[:n], np.ones(n, np.int64))) for n in (10_000, 50_000)]
    assert sizes == [10_000 * lm_scoring.EVENT_BITS, 50_000 * lm_scoring.EVENT_BITS]
    assert lm_scoring.Segment(lm_scoring.segment(hashes[:0], np.zeros(0, np.int64))).levels(hashes).sum() == 0


def test_a_stored_model_scores_documents_it_never_saw(spark, tmp_path):
    """Against the filter-free probabilities: exact base, and a score near that of exact counts."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    seen, unseen = docs.where("doc_id % 3 > 0"), docs.where("doc_id % 3 = 0")
    lm_scoring.fit(seen, str(tmp_path / "model"))
    model = lm_scoring.open_model(spark, str(tmp_path / "model"))
    texts = [(r.doc_id, r.text) for r in unseen.collect()] + [(-1, "quite unknown wörds"), (-2, None)]
    asked = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in lm_scoring.score(asked, model).collect()}
    single, double, starts = Counter(), Counter(), 0
    for r in seen.collect():
        w = tokens(r.text)
        single.update(w)
        double.update(zip(["<s>", *w], w))
        starts += 1
    n, v = sum(single.values()), len(single)
    assert (model.tokens, model.distinct) == (n, v) and len(found) == len(texts)
    errors, size = 0.0, 0
    for i, t in texts:
        w = tokens(t)
        assert (found[i].n_tokens, found[i].n_known) == (len(w), sum(single[x] > 0 for x in w))
        assert found[i].base_score == pytest.approx(sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        exact = sum(math.log10((double[a, b] / max(starts if a == "<s>" else single[a], 1) + (single[b] + 1) / (n + v + 1)) / 2)
                    for a, b in zip(["<s>", *w], w))
        errors, size = errors + found[i].score - exact, size + len(w)
    assert abs(errors) / size < 0.1
    # More texts, other blocks and partitions: the same scores.
    again = {r.doc_id: r for r in lm_scoring.score(asked.unionByName(asked.where("doc_id < 0")).coalesce(1), model).collect()}
    assert all(again[i].score == pytest.approx(found[i].score, rel=1e-12) for i in found)


def test_segments_are_bounded_rows_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "RANGE", 500)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = lm_scoring.fit(docs)
    rows = model.segments.select("pairs", "range", F.length("filter").alias("size"), "tokens").collect()
    assert model.bits > 6 and len(rows) > 2 ** model.bits
    assert max(r["size"] for r in rows) < 40 * sum(r["size"] for r in rows) / len(rows)


def test_no_level_is_left_out(spark, monkeypatch):
    """All pairs in one of the ranges: 800,000 entries, more than the share of a range once held."""
    rng, real = np.random.default_rng(5), lm_scoring.pair_hashes
    monkeypatch.setattr(lm_scoring, "pair_hashes", lambda tokens, number: real(tokens, number) >> np.uint64(8))
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 2000, 20_000)) for _ in range(40)]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    trains = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 != 2][:40]
    rows = [*zip(trains, texts), *zip(held, texts)]
    scored = check(lm_scoring.scores(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    assert len(scored) == 2
    assert abs(sum(g - w for g, w, _ in scored)) / sum(n for *_, n in scored) < 0.1


def test_odd_rows(spark):
    check(lm_scoring.scores(cases.frame(spark)), [r[:2] for r in cases.rows()])
    found = lm_scoring.scores(cases.empty(spark))
    assert found.count() == 0 and found.columns == [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    untrained = cases.frame(spark).where("pmod(crc32(cast(doc_id AS string)), 7) = 2")
    assert all(r.n_known == 0 and r.base_score == 0 for r in lm_scoring.scores(untrained).collect())
