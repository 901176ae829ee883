import random
import re
import sys
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from oracle_compare import compare, connect  # noqa: E402

from bayline.llm import near_dups, oracle  # noqa: E402
from bayline.llm.common import stage, table  # noqa: E402

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Shingle number and component of each (id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    lists, parent = {}, list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in lists.get(s, ()))
        for j, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for s in own:
            lists.setdefault(s, []).append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return {doc_id: (len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)}


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_whole_table_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = stage(near_dups.components(docs), "found")
    assert got(found) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert compare(found, connect("/root/testdata/sf0.01"), oracle.NEAR_DUPS) is None


@pytest.mark.parametrize("short, block", [(32, 4096), (4, 4096), (4, 16), (1000, 4096)])
def test_groups_chains_and_borders(spark, monkeypatch, short, block):
    """Copies, a crowd around one text, a chain that drifts, and pairs on either side of 75 in 100."""
    monkeypatch.setattr(near_dups, "SHORT", short)
    monkeypatch.setattr(near_dups, "BLOCK", block)
    monkeypatch.setattr(near_dups, "ROWS_WITH_SETS", 100)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [word() for _ in range(120)]
    rows = [" ".join(base)] * 40
    for _ in range(60):
        near = list(base)
        near[rng.randrange(120)] = word()
        rows.append(" ".join(near))
    for _ in range(40):  # around the limit: three to five changed words far apart
        near = list(base)
        for at in rng.sample(range(5, 115, 11), rng.randint(2, 5)):
            near[at] = word()
        rows.append(" ".join(near))
    chain = [word() for _ in range(100)]
    for _ in range(30):
        rows.append(" ".join(chain))
        chain = chain[8:] + [word() for _ in range(8)]
    rows += [" ".join(base[:60]), " ".join(w.upper() for w in base), "  ".join(base) + "\n"]
    rng.shuffle(rows)
    rows = list(enumerate(rows, 10))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(near_dups.components(df)) == brute(rows)


def test_signatures_and_names_of_sets():
    sets, counts = near_dups.shingles(*near_dups.Words()(["a b c d e f", "a b", "", None, "f e d c b a", "A B"]))
    assert counts.tolist() == [2, 1, 0, 0, 2, 1]
    names = near_dups.node_ids(sets, counts)
    assert names[1] == names[5] and names[2] == names[3] and len(set(names.tolist())) == 4
    drawn = near_dups.signatures(sets, counts)
    assert (drawn[1] == drawn[5]).all() and not drawn[2].any() and (drawn[0] != drawn[4]).any()
    one = near_dups.signatures(np.concatenate([sets] * 40_000), np.tile(counts, 40_000))
    assert (one.reshape(40_000, -1) == drawn.ravel()).all()


def test_odd_rows(spark):
    found = near_dups.components(cases.frame(spark)).toPandas()
    assert len(found) == len(cases.rows())
    by = {i: g for i, g in found.dropna(subset=["doc_id"]).groupby("doc_id")}
    one = lambda i: tuple(by[i].iloc[0][["n_shingles", "component_id"]])
    assert one(2)[1] == one(3)[1] == 1 and one(8) == (1, 7) and one(4) == (0, 4) and one(5) == (0, 5) and one(6) == (0, 6)
    assert len(by[9]) == 2 and by[9].kept.all() and set(by[12].n_shingles) == {1, 8}
    missing = found[found.doc_id.isna()]
    assert len(missing) == 2 and missing.kept.all() and missing.component_id.isna().all()
    assert near_dups.components(cases.empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = cases.frame(spark)
    kept = near_dups.deduplicated(docs)
    assert kept.schema == docs.schema
    ids = Counter(r.doc_id for r in kept.collect())
    # Both unlike texts of id 12 stay, and one of the two equal rows of id 9.
    assert ids == {i: 1 for i in (1, 4, 5, 6, 7, 9, 10, 11)} | {None: 2, 12: 2}
    assert near_dups.deduplicated(cases.empty(spark)).count() == 0


def test_rows_of_one_id_are_decided_each(spark):
    clean, other = ("this text is like no other one in the whole of this small table of words",
                    "while that one here has got nothing in common with any of the texts before")
    rows = [(1, cases.PROSE, "a"), (2, cases.PROSE, "b"), (2, clean, "c"), (3, other, "d"), (3, other + " at all", "e"),
            (3, None, "f"), (3, "", "g"), (4, clean, "h"), (2, clean, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    for part in (docs, docs.repartition(5), docs.orderBy(F.desc("node"))):
        kept = sorted(map(str, near_dups.deduplicated(part).collect()))
        assert kept == sorted(map(str, near_dups.deduplicated(docs).collect()))
        ids = [(r.doc_id, (r.text or "")[:10]) for r in near_dups.deduplicated(part).collect()]
        assert sorted(ids) == sorted([(1, cases.PROSE[:10]), (2, clean[:10]), (3, other[:10]), (3, "")])
