import numpy as np
import pytest

from bayline.llm import neighbours
from bayline.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, code string, query_id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, every, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[ids == ids[i]] = np.inf
        order = [j for j in np.lexsort((ids, d)) if np.isfinite(d[j])][:k]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = found(neighbours.nearest(vectors))
    want = brute([(r.vec_id, r.embedding) for r in vectors.collect()], 100, 10)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    exact = {(q, i): d for q, v in want.items() for i, d in v}
    assert all(d == pytest.approx(exact[q, i], rel=1e-12) for q, v in got.items() for i, d in v if (q, i) in exact)


def test_copies_ties_and_crowds(spark, monkeypatch):
    """A third of the rows are one vector and another third lies close to it."""
    monkeypatch.setattr(neighbours, "ENTRIES", 64)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    rng = np.random.default_rng(3)
    hot = rng.normal(size=16)
    rows = [(i, (hot if i % 3 == 0 else hot + rng.normal(size=16) * 1e-3 if i % 3 == 1 else rng.normal(size=16)).tolist())
            for i in range(900)]
    rows += [(1000, [1.0] + [0.0] * 15), (1003, [0.0, 1.0] + [0.0] * 14), (1001, [0.0, 1.0] + [0.0] * 14)]
    got, want = found(neighbours.nearest(frame(spark, rows))), brute(rows, 100, 10)
    assert got.keys() == want.keys()
    for q in (0, 300, 600):
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_clustered_vectors_are_settled_by_few_probes():
    """100,000 vectors in clusters: the radius stays small and few codes lie in the probed buckets."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(2000, 32))
    x = np.repeat(centres, 50, axis=0) + rng.normal(size=(100_000, 32)) * 0.05
    rng.shuffle(x)
    centre, rotation, radii = neighbours.learn(x[:neighbours.SAMPLE], 4)
    bits = np.packbits((x - centre) @ rotation >= 0, axis=1, bitorder="little")
    codes = bits.view("<u8").ravel()
    shares, hits, left = [], 0, list(range(0, 100_000, 2000))
    asked = len(left)
    for radius, reach in radii:
        for i in list(left):
            differ = codes ^ codes[i]
            probed = np.zeros(len(codes), bool)
            for part in range(neighbours.PARTS):
                probed |= np.bitwise_count((differ >> np.uint64(16 * part)) & np.uint64(0xFFFF)) <= radius // neighbours.PARTS
            rows = np.flatnonzero(probed & (np.bitwise_count(differ) <= radius))
            distance = np.sqrt(((x[rows] - x[i]) ** 2).sum(1))
            best = rows[np.argsort(distance)][1:11]
            shares.append(probed.mean())
            if len(best) == 10 and np.sort(distance)[10] <= reach:
                left.remove(i)
                exact = ((x - x[i]) ** 2).sum(1)
                exact[i] = np.inf
                hits += len(set(best.tolist()) & set(np.argsort(exact)[:10].tolist()))
    print("probed share", sum(shares) / asked, "settled", asked - len(left), "of", asked, "radii", radii)
    assert len(left) <= 0.1 * asked and sum(shares) / asked < 0.1
    assert hits >= 0.9 * 10 * (asked - len(left))


def test_clusters_settle_early_and_stay_right(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ENTRIES", 256)
    monkeypatch.setattr(neighbours, "QUERIES", 8)
    rng = np.random.default_rng(9)
    x = np.repeat(rng.normal(size=(60, 24)), 40, axis=0) + rng.normal(size=(2400, 24)) * 0.03
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2400 + i, rng.normal(size=24).tolist()) for i in range(100)]
    radii = neighbours.learn(np.array([v for _, v in rows]), 10)[2]
    assert radii and radii[0][0] < 31
    got, want = found(neighbours.nearest(frame(spark, rows), every=50)), brute(rows, 50, 10)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.95 * 10 * len(want)


def test_masks():
    assert neighbours.masks(3, 1) == [0, 1, 2, 4] and neighbours.masks(0, 5) == [0] and len(neighbours.masks(16, 3)) == 697


def test_odd_rows(spark):
    good = [(100, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 4.0]), (9, [1.0, 2.0, 2.0]), (200, [1.0, 2.0, 3.0]),
            (100, [1.0, 2.0, 3.0])]
    bad = [(300, None), (400, [0.0, 0.0, 0.0]), (500, [1.0, None, 2.0]), (600, [1.0, float("nan"), 2.0]),
           (700, [float("inf"), 1.0, 1.0]), (800, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (900, [])]
    got = found(neighbours.nearest(frame(spark, good + bad)))
    assert got == {100: [(200, 0.0), (7, 1.0), (9, 1.0)], 200: [(100, 0.0), (7, 1.0), (9, 1.0)]}
    assert neighbours.nearest(frame(spark, []).limit(0)).count() == 0
    assert neighbours.nearest(frame(spark, bad)).count() == 0
    assert neighbours.nearest(frame(spark, [(100, [1.0, 2.0])])).count() == 0
