"""MinHash near-duplicate detection by an inverted join over signature coordinates.

A document is its set of distinct `WORDS`-word shingles. Documents with equal sets are one node.
A node has a signature of `COORDINATES` minima, and nodes whose sets are `SIMILARITY` percent
alike agree in fewer than `MATCHES` coordinates with a probability of eight in a million only.

- Posting: a (coordinate, value) pair is a key that lists the nodes which have it. Keys with one
  node match nobody, so a node with fewer than `MATCHES` shared keys is out (most are).
- Prefix: two nodes that agree in `MATCHES` coordinates share a key outside any
  `MATCHES` - 1 of them; so each node is posted under all but its `MATCHES` - 1 most frequent keys
  and the longest lists are skipped.
- Merging: the collisions of two members of a list are counted over their signatures; of the lists
  that a pair shares only that of the lowest coordinate handles it. Pairs with enough collisions
  are confirmed on the full sets.

A list never becomes all its pairs. Lists of up to `SHORT` nodes hand on their candidate pairs.
Longer lists are compared where their sets are, in blocks of at most `BLOCK` nodes: members that a
confirmed link has joined aren't compared again, so a crowd of copies costs about one comparison a
member, and at most one link a member leaves the task. Lists of more than one block first go through
pivots: each member is compared to one member of each of its lists, confirmed links join components,
and that repeats with other pivots as long as it halves the pairs of different components. In the end
every pair of nodes that shares a list is either compared or known to be joined.

Defined cases: a document without words (null or empty text) has 0 shingles and links to nothing;
with fewer words than a shingle its whole sequence is its one shingle; rows with a null id are
returned with a null component and kept, and link nothing; repeated rows are returned each with
the same result; extra columns are ignored by `components` and kept by `deduplicated`; empty
tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from bayline.llm.common import prepare, stage
from bayline.llm.words import Words, mixed
from bayline.operators.joins import spread_lookup

WORDS = 5
SIMILARITY = 75
COORDINATES = 32
MATCHES = 13
SHORT = 32
BLOCK = 4096
# Postings to a task, without and with their sets.
ROWS, ROWS_WITH_SETS = 16_384, 4096
# Bits of the filter that keeps most uninvolved texts from being shingled again; 4 MB.
FILTER_BITS = 1 << 25
_CHUNK = 1 << 16


def shingles(hashes: np.ndarray, number: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and how many each has."""
    factor = np.uint64(0x100000001B3)
    joined = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        joined = joined * factor + hashes[k:len(hashes) - words + 1 + k]
    joined = mixed(joined)
    out, counts, at = [np.zeros(0, np.uint64)], np.zeros(len(number), np.int64), 0
    for i, n in enumerate(number.tolist()):
        if n >= words:
            own = np.unique(joined[at:at + n - words + 1])
        elif n:
            value = np.uint64(n)
            for h in hashes[at:at + n]:
                value = np.uint64((int(value) * int(factor) + int(h)) % (1 << 64))
            own = mixed(np.array([value], np.uint64))
        else:
            own = out[0]
        at += n
        out.append(own)
        counts[i] = len(own)
    return np.concatenate(out), counts


def signatures(sets: np.ndarray, counts: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """Minima of `size` hash functions over each non-empty set; zeros for empty ones."""
    rng = np.random.default_rng(20250101)
    factors = rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    filled = np.flatnonzero(counts)
    out = np.zeros((len(counts), size), np.uint32)
    ends = np.cumsum(counts[filled])
    first = 0
    while first < len(filled):
        # Several sets at a time, of about _CHUNK shingles in all.
        low = ends[first] - counts[filled[first]]
        last = max(first + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        some = sets[low:ends[last - 1]]
        starts = ends[first:last] - counts[filled[first:last]] - low
        for j in range(size):
            drawn = (some * factors[j] + shifts[j]) >> np.uint64(32)
            out[filled[first:last], j] = np.minimum.reduceat(drawn, starts)
        first = last
    return out


def node_ids(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(sets + np.uint64(0x9E3779B97F4A7C15)))])
    ends = np.cumsum(counts)
    return mixed(sums[ends] - sums[ends - counts] + counts.astype(np.uint64)).view(np.int64)


def documents_signed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, signature) of every row."""
    def signed(batches):
        words = Words()
        for batch in batches:
            sets, counts = shingles(*words(batch.column("text").to_pylist()))
            drawn = signatures(sets, counts).view(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, drawn.size + 1, COORDINATES), pa.int32()), pa.array(drawn.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(node_ids(sets, counts)), lists],
                ["doc_id", "n_shingles", "node", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        signed, "doc_id long, n_shingles long, node long, signature array<int>")


def posts(nodes: DataFrame) -> DataFrame:
    """(key, at, node, mask, length) of the postings that can lead to a match.

    `at` is the key's coordinate, `mask` has the node's posted coordinates, `length` is the list's.
    """
    drawn = nodes.select("node", F.posexplode("signature").alias("at", "value")).select(
        "node", "at", F.xxhash64("at", "value").alias("key"))
    shared = drawn.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    ranked = drawn.join(shared, "key").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("length", "key", "at"))).alias("keys"))
    # The most frequent MATCHES - 1 keys of a node are skipped.
    kept = ranked.where(F.size("keys") >= MATCHES).select(
        "node", F.slice("keys", 1, F.size("keys") - (MATCHES - 1)).alias("keys"))
    mask = F.aggregate("keys", F.lit(0).cast("long"), lambda m, k: m.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), k["at"])))
    posted = kept.select("node", mask.alias("mask"), F.explode("keys").alias("k")).select(
        F.col("k.key").alias("key"), F.col("k.at").alias("at"), "node", "mask")
    lists = posted.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    return posted.join(lists, "key")


def enough_matches(a: Column, b: Column) -> Column:
    """Whether two signatures agree in `MATCHES` coordinates."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0),
                       lambda n, x: n + x) >= MATCHES


def similar_sizes(a: Column, b: Column) -> Column:
    """Sets of such sizes can reach the similarity."""
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def colliding(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The (a, b) pairs whose sizes and signatures allow the similarity."""
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    return pairs.join(left, "a").join(right, "b").where(
        similar_sizes(F.col("n_a"), F.col("n_b")) & enough_matches(F.col("s_a"), F.col("s_b"))).select("a", "b")


def place_of(doc_id: Column) -> Column:
    """Bit of an id in a filter; places count from 1, as the bitmap functions do."""
    return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(FILTER_BITS)).cast("long") + 1


def id_filter(ids: DataFrame):
    """A broadcast filter of fixed size over the `doc_id`s: a bit that isn't set excludes an id."""
    parts = ids.select(place_of(F.col("doc_id")).alias("place")).groupBy(
        F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[(r["bucket"] - 1) * 4096:(r["bucket"] - 1) * 4096 + len(part)] = part
    return ids.sparkSession.sparkContext.broadcast(bits)


def is_set(bits: np.ndarray, place: pa.Array) -> np.ndarray:
    at = place.to_numpy() - 1
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def involved_sets(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """(node, set) of the involved nodes, each shingled again from one of its documents.

    A filter of fixed size over the involved ids spares most other texts; it lets some through,
    which the joins to come drop.
    """
    sent = id_filter(involved)

    def shingled(batches):
        words, bits, seen = Words(), sent.value, set()
        for batch in batches:
            chosen = batch.filter(pa.array(is_set(bits, batch.column("place"))))
            if not chosen.num_rows:
                continue
            sets, counts = shingles(*words(chosen.column("text").to_pylist()))
            ends = np.cumsum(counts)
            nodes, own = [], []
            for node, low, high in zip(node_ids(sets, counts).tolist(), ends - counts, ends):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    own.append(sets[low:high].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(own, pa.list_(pa.int64()))], ["node", "set"])

    texts = docs.where(F.col("doc_id").isNotNull()).select(
        "text", place_of(F.col("doc_id")).alias("place"))
    found = texts.mapInArrow(shingled, "node long, set array<long>")
    return stage(found.join(involved.select("node"), "node", "left_semi"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs that reach the similarity on their full sets."""
    met = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return met.withColumn("both", both).where(
        100 * F.col("both") >= SIMILARITY * (F.size("set_a") + F.size("set_b") - F.col("both"))
    ).select("a", "b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the links; the component is its smallest node.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the
    smallest of its neighbours, until nothing changes.
    """
    def smallest(ends: DataFrame) -> DataFrame:
        return ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def checksum(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        "u <> v").distinct(), "stars")
    before = None
    while (now := checksum(edges)) != before:
        before = now
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = ways.join(smallest(ways), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = smallest(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def labelled(listed: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The postings with the component of their node."""
    if labels is None:
        return listed.withColumn("component", F.col("node"))
    return listed.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def open_pairs(listed: DataFrame) -> float:
    """Pairs of different components in the lists, a pair once for each list."""
    parts = listed.groupBy("key", "component").agg(F.count("*").cast("double").alias("n")).groupBy("key").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
    return parts.agg(F.coalesce(F.sum(F.col("n") * F.col("n") - F.col("same")) / 2, F.lit(0.0))).first()[0]


def pivot_pairs(listed: DataFrame, turn: int) -> DataFrame:
    """Each node with the pivots of its lists, other components' only; another pivot each turn."""
    pivots = listed.groupBy("key").agg(
        F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn))).alias("p"))
    return listed.join(pivots, "key").where(F.col("component") != F.col("p.component")).select(
        F.col("p.node").alias("a"), F.col("node").alias("b")).distinct()


def pivoted(long: DataFrame, nodes: DataFrame, sets: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Links found by pivots of the long lists, and the components they make."""
    found, labels, turn, before = None, None, 0, None
    if long.isEmpty():
        return found, labels
    while True:
        opened = stage(labelled(long, labels), "open")
        now = open_pairs(opened)
        if now == 0 or before is not None and 2 * now > before:
            return found, labels
        new = stage(confirmed(colliding(pivot_pairs(opened, turn), nodes), sets), "links")
        found = new if found is None else found.unionByName(new)
        labels = stage(connected(found), "components")
        turn, before = turn + 1, now


def collisions(x: int, near: np.ndarray, at: int, drawn: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which of `near` agree with x often enough, in a list of this coordinate; best first."""
    equal = drawn[near] == drawn[x]
    matches = equal.sum(1)
    common = np.packbits(equal, axis=1, bitorder="little").view("<u4").ravel() & mask[near] & mask[x]
    found = np.flatnonzero((matches >= MATCHES) & (common & -common == np.uint32(1 << at)))
    return found[np.argsort(-matches[found], kind="stable")]


def overlap(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Shared elements of a sorted set with each of several non-empty ones."""
    every = np.concatenate(others)
    place = np.minimum(np.searchsorted(own, every), len(own) - 1)
    sizes = np.array([len(o) for o in others])
    return np.add.reduceat((own[place] == every).astype(np.int64), np.cumsum(sizes) - sizes)


def compared(group: pa.Table, confirm: bool) -> pa.Table:
    """Candidate pairs of several lists or, with their sets, links that join what belongs together."""
    key, i, j, own, at, node, component, mask, size = (group.column(c).to_numpy() for c in (
        "key", "i", "j", "own", "at", "node", "component", "mask", "n_shingles"))
    mask = mask.astype(np.uint32)
    drawn = group.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    if confirm:
        lists = group.column("set").combine_chunks()
        ends, elements = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    order = np.lexsort((node, j, i, key))
    change = (np.diff(key[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)
    a, b = [], []
    for rows in np.split(order, np.flatnonzero(change) + 1):
        low, high = i[rows[0]], j[rows[0]]
        label = component[rows].copy()
        right = np.flatnonzero(own[rows] == high)
        for x in np.flatnonzero(own[rows] == low).tolist():
            near = right[label[right] != label[x]]
            if low == high:
                near = near[near > x]
            sizes = size[rows[near]]
            near = near[100 * np.minimum(sizes, size[rows[x]]) >= SIMILARITY * np.maximum(sizes, size[rows[x]])]
            if len(near):
                near = near[collisions(rows[x], rows[near], at[rows[x]], drawn, mask)]
            if not confirm:
                a += [node[rows[x]]] * len(near)
                b += node[rows[near]].tolist()
                continue
            many = 2
            while len(near):
                some, near, many = near[:many], near[many:], 4 * many
                both = overlap(elements[ends[rows[x]]:ends[rows[x] + 1]],
                               [elements[ends[y]:ends[y + 1]] for y in rows[some]])
                for y in some[100 * both >= SIMILARITY * (size[rows[some]] + size[rows[x]] - both)].tolist():
                    if label[y] != label[x]:
                        a.append(node[rows[x]])
                        b.append(node[rows[y]])
                        label[label == label[y]] = label[x]
                near = near[label[near] != label[x]]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def within_lists(rows: DataFrame, confirm: bool) -> DataFrame:
    """`compared` over all lists, several short ones or one pair of blocks at a time."""
    blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
            "i": F.least("own", "other"), "j": F.greatest("own", "other")})
    tasks = rows.count() // (ROWS_WITH_SETS if confirm else ROWS) + 1
    bucket = F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks))
    return dealt.withColumn("bucket", bucket).drop("blocks", "other", "length").repartition(
        tasks, "bucket").groupBy("bucket").applyInArrow(
        lambda group: compared(group, confirm), "a long, b long")


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Node pairs that join every component of similar sets; `nodes` is a stored table."""
    listed = stage(posts(nodes), "posts")
    involved = nodes.join(listed.select("node").distinct(), "node", "left_semi")
    sets = involved_sets(docs, involved.select("node", "doc_id"))
    found, labels = pivoted(listed.where(F.col("length") > BLOCK), nodes, sets)
    rows = labelled(listed, labels).join(nodes.select("node", "n_shingles", "signature"), "node")
    short = confirmed(within_lists(rows.where(F.col("length") <= SHORT), False).distinct(), sets)
    long = rows.where(F.col("length") > SHORT)
    every = short.unionByName(within_lists(long.join(sets, "node"), True))
    return every if found is None else every.unionByName(found)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, component, component_id, kept) of every row.

    `component` tells classes apart that share a smallest id, since rows of one id may differ; it is
    NULL for rows that link with nothing.
    """
    prepare(docs.sparkSession)
    signed = stage(documents_signed(docs), "signed")
    linkable = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes = stage(linkable.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"), F.count("*").alias("copies")), "nodes")
    labels = connected(links(docs, nodes))
    named = nodes.join(labels, "node", "left").select(
        "node", "doc_id", "copies", F.coalesce("component", "node").alias("component"))
    # A component is named by its smallest document, not by its smallest node.
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    lookup = stage(named.join(least, "component").select(
        F.col("node").alias("linked"), "component", "component_id", "copies"), "lookup")
    rows = signed.select("doc_id", "n_shingles", "node", F.when(
        (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("node")).alias("linked"))
    joined = spread_lookup(rows, lookup, ["linked"], "copies", ["component", "component_id"], [F.col("doc_id")])
    name = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", "node", "component", name.alias("component_id"),
                         F.coalesce(F.col("doc_id") == name, F.lit(True)).alias("kept"))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return classes(docs).select("doc_id", "n_shingles", "component_id", "kept")


def with_node(docs: DataFrame, name: str) -> DataFrame:
    """The rows with the name of their shingle set."""
    columns = docs.columns

    def named(batches):
        words = Words()
        for batch in batches:
            nodes = node_ids(*shingles(*words(batch.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(nodes)], [*columns, name])

    return docs.mapInArrow(named, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def unlike_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of rows with repeated ids, one of each class that the id names.

    `found` has the classes of just these rows. Which of several rows depends on their content only.
    """
    chosen = found.where("kept").groupBy("doc_id", "component", (F.col("n_shingles") == 0).alias("empty")).agg(
        F.min("node").alias("node")).select(F.col("doc_id").alias("_id"), F.col("node").alias("_chosen"))
    names = docs.columns
    rows = with_node(docs, "_node").join(
        chosen, (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_node") == F.col("_chosen")))
    first = Window.partitionBy("_id", "_node").orderBy(F.xxhash64(F.to_json(F.struct(*names))))
    return rows.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select(names)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class of near duplicates, with all its columns.

    Decided for rows, not ids: of rows that share an id, each stays whose text isn't like that of
    a smaller id's row, and of like rows with one id one stays.
    """
    rows = stage(classes(docs).where(F.col("doc_id").isNotNull()), "classes")
    found = stage(rows.groupBy("doc_id").agg(
        F.min("kept").alias("kept"), F.count("*").alias("rows")), "kept")
    special = found.where("not kept or rows > 1").select("doc_id")
    sent, names = id_filter(special), docs.columns
    place = "_place"
    while place in names:
        place += "_"
    placed = docs.withColumn(place, place_of(F.col("doc_id")))

    def passed(wanted: bool) -> DataFrame:
        def chosen(batches):
            for batch in batches:
                hit = is_set(sent.value, batch.column(place))
                yield batch.filter(pa.array(hit if wanted else ~hit)).select(names)

        return placed.mapInArrow(chosen, docs.schema)

    # Rows that the filter excludes stay; only the others, with their texts, are joined.
    doubtful = passed(True)
    out = passed(False).unionByName(
        doubtful.join(special, doubtful["doc_id"].cast("long") == special["doc_id"], "left_anti"))
    repeated = found.where("rows > 1").select("doc_id")
    if repeated.isEmpty():
        return out
    again = docs.join(repeated, docs["doc_id"].cast("long") == repeated["doc_id"], "left_semi")
    return out.unionByName(unlike_rows(again, rows.join(repeated, "doc_id", "left_semi")))
