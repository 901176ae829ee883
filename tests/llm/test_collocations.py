import re
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from oracle_compare import compare, connect

from bayline.llm import collocations
from bayline.llm.common import table
from bayline.llm.oracle import COLLOCATIONS

SF = "/root/testdata/sf0.001"


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least, most):
    """(lang, text) rows, by counting every phrase."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        long = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in long.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        found = []
        for p, a in long.items():
            if 100 * longer[p] >= 80 * a and longer[p]:
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    words = ["the", "Of", "new", "york", "é", "a-b", "x\x0b", "city.", "big\t", "日本", *(f"w{i}" for i in range(40))]
    rows = []
    for i in range(150):
        text = " ".join(words[int(k)] for k in rng.zipf(1.3, 60) % len(words))
        rows.append((["en", "fr", None][i % 3], text + " in new york city" * (i % 4)))
    return rows + [("en", "of the " * 800), ("en", None), (None, ""), ("de", "kurz")]


@pytest.mark.parametrize("block,range_bytes,hot", [
    (1 << 20, 16_000_000, 64), (100, 2000, 64), (300, 1000, 3), (1 << 20, 500, 1), (1, 5000, 1)])
def test_blocks_ranges_and_hot_pairs_change_nothing(spark, corpus, monkeypatch, block, range_bytes, hot):
    monkeypatch.setattr(collocations, "_HOT_LEAST", hot)
    docs = spark.createDataFrame(corpus, "lang string, text string").repartition(4)
    got = found(collocations.collocations(docs, least=5, most=40, block=block, range_bytes=range_bytes))
    assert got == brute(corpus, 5, 40) and len(got) > 60


def test_marked_pairs_are_dealt_by_the_whole_window(corpus):
    """No range holds more than its share of a pair that leads very many windows."""
    text = " ".join(f"a b v{i} x ." for i in range(4000))
    vocabulary = collocations.Codes(b".")
    codes = vocabulary.of(next(collocations.tokens(text.encode())))
    sizes = [collocations.unpacked_windows(d)[1].shape[1]
             for _, d in collocations.block_windows(vocabulary, codes, len(codes), 10, 64)]
    assert len(sizes) == 10 and max(sizes) < 2 * sum(sizes) / 10


def test_windows_reach_across_slices(monkeypatch):
    text = " ".join(f"{'long' * (i % 5)} of the city{'.' * (i % 11 == 0)}" for i in range(300))
    rows = [("en", text), ("en", "z" * 50 + " of"), ("fr", text)]
    whole = next(collocations.tokens(text.encode()))
    want = sorted(window_counts(rows, 1 << 20, 1 << 20, monkeypatch))
    for block, size in ((40, 64), (5, 10), (1000, 1), (1, 1)):
        with monkeypatch.context() as m:
            m.setattr(collocations, "_SLICE", size)
            parts = list(collocations.tokens(text.encode()))
        assert len(parts) > 50 and sum(parts, []) == whole
        assert sorted(window_counts(rows, block, size, monkeypatch)) == want


def window_counts(rows, block, size, monkeypatch):
    """All windows of the rows as one partition finds them, summed."""
    import pyarrow as pa

    class Frame:
        def mapInArrow(self, fold, schema):
            self.fold = fold
            return self

    with monkeypatch.context() as m:
        m.setattr(collocations, "_SLICE", size)
        fold = collocations.windows(Frame(), 3, block).fold
        batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1].encode() for r in rows]})
        sums = Counter()
        for out in fold(iter([batch])):
            for lang, data in zip(out.column("lang").to_pylist(), out.column("data").to_pylist()):
                words, columns = collocations.unpacked_windows(data)
                for *codes, n, _ in columns.T.tolist():
                    sums[(lang, *(words[c] for c in codes))] += n
    return sums.items()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=60), st.integers(1, 9))
def test_padding_keeps_the_sums_of_frequent_prefixes(codes, least):
    columns = np.array(collocations.lead_windows(np.array(codes, np.int64)))
    n = np.ones(columns.shape[1], np.int64)
    want = Counter(tuple(c[:m]) for c in columns.T.tolist() for m in range(1, 5) if c[m - 1])
    kept, sums = collocations.padded_windows(columns.copy(), n, np.zeros_like(n), least)
    got = Counter()
    for c, k in zip(kept.T.tolist(), sums.tolist()):
        for m in range(1, 5):
            if c[m - 1]:
                got[tuple(c[:m])] += k
    for p, f in want.items():
        assert got[p] == f if f >= least or len(p) == 1 else got[p] in (0, f)
    assert len(set(map(tuple, kept.T.tolist()))) == kept.shape[1]


def test_odd_rows(spark):
    rows = [(r[2], r[1]) for r in cases.rows()]
    assert found(collocations.collocations(cases.frame(spark), least=2)) == brute(rows, 2, 2000)
    assert collocations.collocations(cases.empty(spark)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9 * 10**12 + 1
    phrases = spark.createDataFrame([
        ("en", 1, "a", 2 * big), ("en", 1, "b", big), ("en", 2, "a b", big)], "lang string, size int, phrase string, f long")
    assert collocations.scored(phrases).first().score == 2000000 * big // (3 * big)


def test_matches_sql(spark):
    con = connect("/root/testdata/sf0.01")
    assert compare(collocations.collocations(table(spark, "/root/testdata/sf0.01", "documents")), con, COLLOCATIONS) is None
    con.close()
