import hashlib
import re
import struct

import cases
import xxhash

from bayline.llm import fingerprints
from bayline.llm.common import table

MASK = (1 << 64) - 1
POSITION = (1 << 30) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h(*values):
    """Spark's xxhash64: each value seeds the next; (kind, value) with kinds s, q (long), i (int)."""
    seed = 42
    for kind, v in values:
        data = v.encode() if kind == "s" else struct.pack("<" + kind, v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def brute(text):
    """The sketch, read off the definition."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\x0c\r")) if w]
    hashes = [h(("s", w)) for w in words]
    grams = [h(("q", a), ("q", hashes[i + 1])) if i + 1 < len(hashes) else h(("q", a)) for i, a in enumerate(hashes)]
    seen, numbered = {}, []
    for pos, g in enumerate(grams):
        g = (g & ~POSITION)
        n = seen[g] = seen.get(g, -1) + 1
        if n:
            numbered.append((h(("q", g >> 30), ("i", n)) & ~POSITION) | pos)
        else:
            numbered.append(g | pos)
    out = []
    for j, offset in enumerate(fingerprints.OFFSETS):
        drawn = sorted(numbered, key=lambda x: (x - offset) & MASK)[:fingerprints.LENGTH]
        acc = h(("i", j))
        for x in sorted(drawn, key=lambda x: x & POSITION):
            acc = h(("q", acc), ("q", x >> 30))
        out.append(format(acc & 0xFFFFFFFF, "08x"))
    return "".join(out)


def edited(texts):
    """Edited texts of (id, text) rows that are in following order."""
    for n, (i, t) in enumerate(texts):
        after = texts[(n + 1) % len(texts)][1]
        m = len(t) // 3
        yield i, t, t[:len(t) - m] + after[:m]


def test_whole_table_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id", ascending=False).collect()]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    assert len(got) == len(texts)
    prints = {i: brute(t) for i, t in texts}
    like = lambda a, b: sum(a[k:k + 8] == b[k:k + 8] for k in range(0, len(a), 8)) / fingerprints.SKETCHES
    for n, (i, t, e) in enumerate(edited(texts)):
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == prints[i] and r.edited_fingerprint == brute(e)
        assert r.near_edited == like(prints[i], brute(e))
        assert r.near_next == like(prints[i], prints[texts[(n + 1) % len(texts)][0]])
    far = [r.near_edited - r.near_next for r in got.values() if r.n_chars > 300]
    assert sum(x > 0 for x in far) > 0.9 * len(far)


def test_likeness_is_near_that_of_very_many_draws():
    """Against 400 independent hash functions over all k-mers, on whole texts of the table."""
    import random

    import duckdb

    rng = random.Random(4)
    texts = [r[0] for r in duckdb.sql("SELECT text FROM read_parquet('/root/testdata/sf0.01/documents.parquet') "
                                      "WHERE n_chars > 300 ORDER BY doc_id LIMIT 150").fetchall()]
    salts = [rng.getrandbits(64) for _ in range(400)]

    def numbered(text):
        words, seen, out = text.split(), {}, []
        for gram in zip(words, words[1:]):
            seen[gram] = seen.get(gram, -1) + 1
            out.append(xxhash.xxh64_intdigest(repr((gram, seen[gram]))))
        return out

    def draws(grams):
        got = []
        for salt in salts:
            least = sorted(range(len(grams)), key=lambda i: (grams[i] ^ salt) * 0x9E3779B97F4A7C15 & MASK)[:2]
            got.append(tuple(grams[i] for i in sorted(least)))
        return got

    errors = []
    for text, (_, _, changed) in zip(texts[::3], edited([(i, t) for i, t in enumerate(texts)][::3])):
        a, b = numbered(text), numbered(changed)
        true = sum(x == y for x, y in zip(draws(a), draws(b))) / len(salts)
        x, y = brute(text), brute(changed)
        errors.append(sum(x[k:k + 8] == y[k:k + 8] for k in range(0, len(x), 8)) / fingerprints.SKETCHES - true)
    root_mean_square = (sum(e * e for e in errors) / len(errors)) ** 0.5
    print("root mean square error of the likeness", root_mean_square, "worst", max(map(abs, errors)))
    assert root_mean_square < 0.1 and abs(sum(errors) / len(errors)) < 0.03


def test_order_matters(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[30:] + words[:30])), (3, " ".join(words[:58] + ["x", "y"]))]
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    same = lambda a, b: sum(got[a][k:k + 8] == got[b][k:k + 8] for k in range(0, 8 * fingerprints.SKETCHES, 8))
    assert same(1, 3) > same(1, 2)


def test_chunks_join_up(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CHUNK", 3)
    rows = [(i * i, f"text number {i} " * (i % 4 + 1)) for i in range(40)]
    got = fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {i: hashlib.sha256(e.encode()).hexdigest() for i, _, e in edited(sorted(rows, reverse=True))}
    assert {r.doc_id: r.edited_sha256 for r in got} == want


def test_null_ids_are_spread_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CHUNK", 4)
    rows = [(i if i % 2 else None, f"text number {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.edited_fingerprints(docs).collect()
    tie = {t: h(("s", t)) for _, t in rows}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    want = sorted((str(i), hashlib.sha256(e.encode()).hexdigest()) for i, _, e in edited(order))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == want


def test_odd_rows(spark):
    got = fingerprints.edited_fingerprints(cases.frame(spark)).collect()
    assert len(got) == len(cases.rows())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == by[2][0].fingerprint == next(
        r.fingerprint for r in by[None] if r.n_chars) != by[3][0].fingerprint
    assert by[4][0].fingerprint == by[5][0].fingerprint == by[6][0].fingerprint == brute("")
    assert by[12][0].n_chars != by[12][1].n_chars and by[9][0].n_chars == by[9][1].n_chars
    assert by[4][0].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert fingerprints.edited_fingerprints(cases.empty(spark)).count() == 0
    alone = fingerprints.edited_fingerprints(cases.frame(spark).where("doc_id = 7")).first()
    assert alone.near_next == 1.0
