import re
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
from oracle_compare import compare, connect

from bayline.llm import divergence
from bayline.llm.common import table
from bayline.llm.oracle import DIVERGENCE

SF = "/root/testdata/sf0.001"


def brute(rows, least=3, top=200):
    """(lang, source, text) rows, by plain dictionaries."""
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        counts[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        of = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        of[None] = {t: sum(of[s][t] for s in sources) for t in kept}
        size = {s: sum(c.values()) + len(kept) for s, c in of.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // size[s] for t in kept} for s, c in of.items()}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            q = p[None]
            words = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", words, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def many_sources(spark):
    rng = np.random.default_rng(1)
    words = ["w" + chr(97 + i % 26) * (i // 26 + 1) + x for i in range(60) for x in ("", "é")]
    rows = []
    for i in range(300):
        source = "big" if i % 3 == 0 else f"s{rng.integers(9)}"
        text = " ".join(words[int(k)] for k in rng.zipf(1.4, 30) % len(words))
        rows.append((["en", "fr", None][i % 7 % 3], source, text.upper() if i % 5 == 0 else text))
    return rows


@pytest.mark.parametrize("cells,shard,block", [(400_000, 1024, 128), (50, 7, 128), (120, 16, 3)])
def test_spills_shards_and_blocks_change_nothing(spark, many_sources, cells, shard, block):
    docs = spark.createDataFrame(many_sources, "lang string, source string, text string").repartition(5)
    assert found(divergence.audit(docs, cells=cells, shard=shard, block=block)) == brute(many_sources)


def test_a_low_limit_of_terms_keeps_the_foremost(spark, many_sources):
    docs = spark.createDataFrame(many_sources, "lang string, source string, text string")
    assert found(divergence.audit(docs, top=3, shard=10)) == brute(many_sources, top=3)


def test_odd_rows(spark):
    rows = [(r[2], r[3], r[1]) for r in cases.rows()]
    assert found(divergence.audit(cases.frame(spark))) == brute(rows)
    assert divergence.audit(cases.empty(spark)).count() == 0
    few = [("xx", "a", "one"), ("xx", "b", None), ("yy", None, "")]
    docs = spark.createDataFrame(few, "lang string, source string, text string")
    assert found(divergence.audit(docs)) == brute(few) == [
        ("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]


def test_long_texts_are_read_in_slices(monkeypatch):
    text = ("Grün Äb-c d'E 12x日本 " * 50).encode()
    whole = next(divergence.terms(text))
    monkeypatch.setattr(divergence, "_SLICE", 7)
    parts = list(divergence.terms(text))
    assert len(parts) > 50 and sum(parts, []) == whole and whole.count("x日本".encode()) == 50
    assert list(divergence.terms(b"a" * 100)) == [[b"a" * 100]]


def test_stripes_of_a_term_are_merged_across_batches(spark, many_sources):
    docs = spark.createDataFrame(many_sources, "lang string, source string, text string").na.fill("")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    got = divergence.merged(divergence.folded(docs.repartition(6), 10), 3).collect()
    divergence.prepare(spark)
    want = defaultdict(Counter)
    df = Counter()
    for lang, source, text in many_sources:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        for t in set(found):
            df[lang or "", t] += 1
        for t in found:
            want[lang or "", t][source] += 1
    kept = {k: dict(c) for k, c in want.items() if df[k] >= 3}
    assert {(r.lang, r.term): dict(zip(r.sources, r.counts)) for r in got} == kept
    assert all(r.n == sum(r.counts) for r in got)


def test_shares_are_exact_for_large_counts():
    counts, total = [0, 5, 10**15 - 1, 3 * 10**15], 4 * 10**15 + 7
    got = divergence.shares(np.array(counts, np.int64), np.int64(total)).tolist()
    assert got == [1 + 10**9 * (c + 1) // total for c in counts]


def test_matches_sql(spark):
    con = connect(SF)
    assert compare(divergence.audit(table(spark, SF, "documents")), con, DIVERGENCE) is None
    con.close()
