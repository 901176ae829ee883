"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (principal axes, then iterative quantisation) turns each
vector into a `BITS`-bit code, which is split into `PARTS` substrings. All codes within a Hamming
radius r of a query agree with it in at least one substring up to r // `PARTS` bits, so each
substring is indexed on its own, a query probes the buckets of nearby substring values, and what it
finds there is reranked by the exact distance. Every vector is indexed.

The radius grows by query. The sample tells for each radius the distance up to which it holds a
share of `REACH` of all pairs; a query is settled once its k-th best lies within that distance, and
only the others go on to the next of `RADII`, and in the end to a search without a radius. Radii
that would settle next to none of the sample are left out.

Equal vectors are one entry that carries its smallest ids, so copies make no pairs. The index is
dealt by substring, range of its values and, where a range is crowded, part of it; so are the queries
that probe a range, and ranges that nobody probes are not sent. A task keeps the best of a query
only, and reports a row under the first substring that finds it, so nothing is lost or told twice.

Defined cases: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, and neither do rows with a null id; equal ids are one query,
which no row of that id answers; ties go to the smaller id; queries get all candidates if there are
fewer than asked for; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from bayline.llm.common import prepare, stage

K = 10
EVERY = 100
BITS, PARTS = 64, 4
SAMPLE = 10_000
ASKED = 500
REACH = 0.98
# Radii tried one after the other: substrings that differ in up to 0, 1, 3 and 7 bits.
RADII = (3, 7, 15, 31)
# A radius that would settle fewer of the sample's queries isn't tried.
WORTH = 0.02
# Entries and queries that meet in a task.
ENTRIES, QUERIES = 16_384, 8_192
_WIDTH = BITS // PARTS


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    most = sizes.orderBy(F.desc("rows"), "n").first()
    return rows.where(F.size("vector") == (most["n"] if most else 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """Different vectors: (entry, h1, h2, vector, ids); entry and ids are the smallest ids."""
    named = rows.select("vec_id", "vector", F.xxhash64("vector").alias("h1"),
                        F.xxhash64(F.lit(1), "vector").alias("h2"))
    # Spark cuts to the first k + 1 before the shuffle too, so no group gathers its copies.
    first = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    return named.withColumn("at", first).where(F.col("at") <= k + 1).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("entry"), F.first("vector").alias("vector"),
        F.array_sort(F.collect_set("vec_id")).alias("ids"))


def learn(sample: np.ndarray, k: int, rounds: int = 30, seed: int = 5) -> tuple[np.ndarray, np.ndarray, list[tuple[int, float]]]:
    """Centre, rotation, and the radii with the distances that they settle."""
    rng = np.random.default_rng(seed)
    centre = sample.mean(0)
    x = sample - centre
    size = x.shape[1]
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :BITS]
    # Each turn of quantisation brings the rotated sample closer to its own signs.
    turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        signs = np.where(x @ axes @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd((x @ axes).T @ signs)
        turn = u @ v
    rotation = axes @ turn
    while rotation.shape[1] < BITS:
        rotation = np.concatenate([rotation, np.linalg.qr(rng.normal(size=(size, size)))[0]], 1)
    rotation = rotation[:, :BITS]
    return centre, rotation, learn_reach(x, (x @ rotation >= 0).astype(np.float32), k)


def learn_reach(x: np.ndarray, codes: np.ndarray, k: int) -> list[tuple[int, float]]:
    """(radius, distance): of the sample's pairs within the distance, `REACH` lie within the radius.

    Only radii that settle some of the sample's queries, by their own k-th nearest.
    """
    asked = min(ASKED, len(x))
    near = min(k, len(x) - 1)
    if not near:
        return []
    distance = np.sqrt(np.array([((x - row) ** 2).sum(1) for row in x[:asked]]))
    distance[np.arange(asked), np.arange(asked)] = np.inf
    apart = np.array([np.abs(codes - code).sum(1) for code in codes[:asked]])
    last = np.sort(distance, axis=1)[:, near - 1]
    order = np.argsort(distance, axis=None, kind="stable")[:distance.size - asked]
    sorted_distance, sorted_apart = distance.ravel()[order], apart.ravel()[order]
    found = []
    for radius in RADII:
        share = np.cumsum(sorted_apart <= radius) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(share >= REACH)
        reach = float(sorted_distance[enough[-1]]) if len(enough) else -1.0
        if (last <= reach).mean() >= WORTH:
            found.append((radius, reach))
    return found


def coded(rows: DataFrame, centre: np.ndarray, rotation: np.ndarray) -> DataFrame:
    """The rows with their code, its first component in the lowest bit."""
    def signed(batches):
        for batch in batches:
            x = np.stack(batch.column("vector").to_numpy(zero_copy_only=False)).astype(np.float64) if batch.num_rows \
                else np.zeros((0, len(centre)))
            bits = np.packbits((x - centre) @ rotation >= 0, axis=1, bitorder="little")
            code = pa.array(np.ascontiguousarray(bits).view("<i8").ravel(), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, code], [*batch.schema.names, "code"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(signed, schema + ", code long")


def substring() -> Column:
    """The value of column `code` at column `part`."""
    return F.expr(f"cast(shiftrightunsigned(code, part * {_WIDTH}) & {(1 << _WIDTH) - 1} as int)")


def masks(bits: int, most: int) -> list[int]:
    """The numbers of `bits` bits with at most `most` ones."""
    return sorted((m for m in range(1 << bits) if m.bit_count() <= most), key=lambda m: (m.bit_count(), m))


def dealt(index: DataFrame, queries: DataFrame, radius: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Index and queries with the (part, bucket, split, block) they meet under."""
    n = index.count()
    bits = int(min(_WIDTH, max(0, np.ceil(np.log2(max(1, n / ENTRIES))))))
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    bucket = F.shiftright(substring(), _WIDTH - bits)
    posted = index.withColumn("part", each).withColumn("bucket", bucket)
    # The top bits of a substring differ in no more bits than all of it.
    near = F.array(*[F.lit(m) for m in masks(bits, radius // parts)])
    probes = queries.select(F.col("entry").alias("query"), F.col("vector").alias("wanted"), "code").withColumn(
        "part", each).withColumn("own", bucket).withColumn("mask", F.explode(near)).withColumn(
        "bucket", F.col("own").bitwiseXOR(F.col("mask"))).drop("own", "mask")
    # A crowded bucket is split, and so are the queries that probe it; each split meets each block.
    places = ["part", "bucket"]
    crowds = stage(
        posted.groupBy(*places).agg(F.ceil(F.count("*") / (2 * ENTRIES)).cast("int").alias("splits")).join(
            probes.groupBy(*places).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks")), places), "buckets")
    left = posted.join(crowds, places).withColumn(
        "split", F.pmod(F.xxhash64("entry"), F.col("splits")).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("splits", "blocks")
    right = probes.join(crowds, places).withColumn(
        "split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).withColumn(
        "block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")).drop("splits", "blocks")
    return left, right.withColumnRenamed("code", "asked")


def search(index: DataFrame, queries: DataFrame, radius: int, parts: int, k: int) -> DataFrame:
    """(query, entry, ids, score): the k + 1 nearest entries of each query entry within the radius."""
    left, right = dealt(index, queries, radius, parts)
    reach = radius // parts
    mask = np.uint64((1 << _WIDTH) - 1)

    def met(entries: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if entries.num_rows and asked.num_rows:
            part = entries.column("part")[0].as_py()
            codes, names = (entries.column(c).to_numpy() for c in ("code", "entry"))
            codes = codes.view(np.uint64)
            vectors = np.stack(entries.column("vector").to_numpy()).astype(np.float64)
            ids = entries.column("ids")
            # The directory: rows by the value of this part, so that a probe sees each value once.
            values = (codes >> np.uint64(part * _WIDTH)) & mask
            order = np.argsort(values, kind="stable")
            listed, starts = np.unique(values[order], return_index=True)
            stops = np.append(starts[1:], len(order))
            wanted = asked.column("asked").to_numpy().view(np.uint64)
            query_vectors = np.stack(asked.column("wanted").to_numpy()).astype(np.float64)
            for query, code, vector in zip(asked.column("query").to_pylist(), wanted, query_vectors):
                own = (code >> np.uint64(part * _WIDTH)) & mask
                hit = np.bitwise_count(listed ^ own) <= reach
                if not hit.any():
                    continue
                rows = order[np.repeat(hit, stops - starts)]
                differ = codes[rows] ^ code
                keep = np.bitwise_count(differ) <= radius
                for earlier in range(part):
                    keep &= np.bitwise_count((differ >> np.uint64(earlier * _WIDTH)) & mask) > reach
                rows = rows[keep]
                score = np.sqrt(((vectors[rows] - vector) ** 2).sum(1))
                best = np.lexsort((names[rows], score))[:k + 1]
                out += [(query, int(names[rows[i]]), ids[int(rows[i])].as_py(), float(score[i])) for i in best]
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.float64())],
                        ["query", "entry", "ids", "score"])

    keys = ["part", "bucket", "split", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        met, "query long, entry long, ids array<long>, score double")
    nearest = F.row_number().over(Window.partitionBy("query").orderBy("score", "entry"))
    return found.withColumn("at", nearest).where(F.col("at") <= k + 1).drop("at")


def nearest(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the `k` nearest rows of each query."""
    prepare(vectors.sparkSession)
    rows = usable(vectors)
    different = stage(entries(rows, k), "entries")
    drawn = different.orderBy("h1").limit(SAMPLE).select("vector").collect()
    if not drawn:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0.0).alias("score")).where("false")
    centre, rotation, radii = learn(np.array([r["vector"] for r in drawn], np.float64), k)
    index = stage(coded(different, centre, rotation), "index")
    asked = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("h1"),
        F.xxhash64(F.lit(1), "vector").alias("h2")).distinct()
    asked = stage(asked.join(index.select("h1", "h2", "entry"), ["h1", "h2"]).select("query_id", "entry"), "asked")
    index = index.select("entry", "vector", "ids", "code")
    queries = index.join(asked.select("entry").distinct(), "entry", "left_semi")

    left = stage(queries, "queries")
    parts = []
    for radius, reach in radii:
        within = stage(search(index, left, radius, PARTS, k), "within")
        # A query needs k rows beside its own, the last of them within the settled distance.
        rows_found = within.groupBy("query").agg(
            F.sum(F.size("ids")).alias("rows"), F.max("score").alias("last")).select(
            F.col("query").alias("entry"), ((F.col("rows") > k) & (F.col("last") <= reach)).alias("settled"))
        settled = stage(rows_found.where("settled").select("entry"), "settled")
        parts.append(within.join(settled.select(F.col("entry").alias("query")), "query", "left_semi"))
        left = stage(left.join(settled, "entry", "left_anti"), "left")
    parts.append(search(index, left, BITS, 1, k))
    found = reduce(DataFrame.unionByName, parts)
    answers = asked.join(found, asked["entry"] == found["query"]).select(
        "query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id").groupBy(
        "query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
