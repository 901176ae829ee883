"""Order MinHash fingerprints, sensitive to edit distance.

The k-mers of a text are its runs of `K` words (shorter at the end). Each is numbered by how often
it occurred before, so that repeats count, and every numbered k-mer of the whole text gets a hash.
Each of `SKETCHES` hash functions, that hash less the function's own offset on the circle of hash
values, picks the `LENGTH` k-mers that are smallest under it, puts them back into text order and
hashes that tuple. As all functions turn the same circle, the k-mers are sorted once and each
function finds its smallest by bisection: they are the first at or after its offset. Offsets lie
evenly, so functions look at different k-mers wherever there are enough. The likeness of two
fingerprints is the share of equal tuples: it needs the same k-mers in the same order.

A hash and its word position share a long (34 and 30 bits, as no text has 2**30 words), so that
sorting is on plain longs. All of it is DataFrame code.

Defined cases: null and empty texts have no k-mers and share one fingerprint, unlike any other;
texts with fewer than `LENGTH` k-mers use what they have; equal texts have equal fingerprints.
Documents follow each other by descending id, equal ids by a hash of the text, null ids last, and
the first follows the last (a single document follows itself). Rows of one id, unless it is null,
meet in one task. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bayline.llm.common import let, prepare

K = 2
SKETCHES = 24
LENGTH = 2
_POSITION_BITS = 30
_POSITION = (1 << _POSITION_BITS) - 1
_HASH = ~_POSITION
# Offsets of the hash functions, as longs.
OFFSETS = [-(1 << 63) + (i * (1 << 64) // SKETCHES & ~_POSITION) for i in range(SKETCHES)]
# Neighbouring documents meet in chunks of about so many rows; the bounds of so many chunks go into
# the plan, so chunks grow beyond 32 million documents (to 1.5 GB of text at 100 TB).
CHUNK = 512
_MOST_CHUNKS = 65_536
_BLANK = " \t\n\x0b\x0c\r"


def _first_not_below(values: Column, wanted: Column, high: Column) -> Column:
    """Index of the first element of a sorted array that isn't below a value, at most `high`."""
    def halve(found, _):
        middle = F.shiftright(found["low"] + found["high"], 1)
        below = (found["low"] < found["high"]) & (F.get(values, middle) < wanted)
        return F.struct(F.when(below, middle + 1).otherwise(found["low"]).alias("low"),
                        F.when(below, found["high"]).otherwise(middle).alias("high"))

    steps = F.ceil(F.log2(high + 2)).cast("int")
    return F.aggregate(F.sequence(F.lit(0), steps), F.struct(F.lit(0).alias("low"), high.alias("high")),
                       halve, lambda found: found["low"])


def _numbered(values: Column) -> Column:
    """Sorted k-mers to occurrence-numbered ones: repeats get a hash of their own."""
    def number(x, i):
        before = F.get(values, i - 1)
        repeated = (i > 0) & (before.bitwiseAND(F.lit(_HASH)) == x.bitwiseAND(F.lit(_HASH)))
        first = _first_not_below(values, x.bitwiseAND(F.lit(_HASH)), i)
        again = F.xxhash64(F.shiftright(x, _POSITION_BITS), i - first)
        return F.when(repeated, again.bitwiseAND(F.lit(_HASH)).bitwiseOR(x.bitwiseAND(F.lit(_POSITION)))).otherwise(x)

    return F.transform(values, number)


def kmers(text: Column, k: int = K) -> Column:
    """Packed hash and position of the k-mer that starts at each word."""
    words = F.split(text, r"[\x20\x09-\x0D]+")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    joined = let(hashes, lambda h: _runs(h, k))
    packed = F.transform(joined, lambda x, i: x.bitwiseAND(F.lit(_HASH)).bitwiseOR(
        i.cast("long").bitwiseAND(F.lit(_POSITION))))
    return F.when(text == "", F.expr("cast(array() as array<bigint>)")).otherwise(packed)


def _runs(hashes: Column, k: int) -> Column:
    out = hashes
    for i in range(1, k):
        out = F.zip_with(out, F.slice(hashes, i + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))
        # zip_with pads with nulls; a null adds nothing to a hash, so the last runs are shorter.
    return out


def sketch(text: Column) -> Column:
    """Hash of the ordered tuple of each of the `SKETCHES` hash functions."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK))
    numbered = let(F.sort_array(let(trimmed, kmers)), _numbered)

    def tuple_hash(values, offset, j):
        n = F.size(values)
        start = _first_not_below(values, offset, n)
        smallest = F.transform(F.slice(F.array(*[F.lit(i) for i in range(LENGTH)]), F.lit(1), n), lambda i: F.get(
            values, (start + i) % n))
        in_order = F.sort_array(F.transform(smallest, lambda x: F.struct(
            x.bitwiseAND(F.lit(_POSITION)).alias("position"), F.shiftright(x, _POSITION_BITS).alias("hash"))))
        return F.aggregate(in_order, F.xxhash64(j), lambda acc, x: F.xxhash64(acc, x["hash"]))

    offsets = F.array(*[F.lit(x).cast("long") for x in OFFSETS])
    return let(F.sort_array(numbered), lambda values: F.transform(
        offsets, lambda offset, j: tuple_hash(values, offset, j)))


def as_text(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda x: F.lpad(F.lower(F.hex(
        x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return same / F.lit(float(SKETCHES))


def with_next(docs: DataFrame, key: str, tie: str, columns: list[str], derive) -> DataFrame:
    """Each row with `next_<column>` of the row that follows it by descending key, cyclically.

    Rows meet in chunks of the key's range, one shuffle of the rows. The first row of a chunk goes
    to the chunk before it too, where it comes last and is dropped again. `derive` adds costly
    columns to the rows before they are shuffled.
    """
    n, bounds = docs.select(key).agg(
        F.count("*"), F.percentile_approx(key, [i / 64 for i in range(1, 64)], 10_000)).first()
    chunks = min(_MOST_CHUNKS, n // CHUNK + 1)
    if chunks > 1:
        bounds = docs.select(key).agg(F.percentile_approx(
            key, [i / chunks for i in range(1, chunks)], max(10_000, 10 * chunks))).first()[0]
    bounds = sorted(set(bounds or ()))
    nulls = docs.where(F.col(key).isNull()).count()
    null_chunks = min(_MOST_CHUNKS, nulls // CHUNK + 1)
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")
    # Chunk 0 holds the largest keys; the last ones the null keys, by equal ranges of the tie.
    range_of_tie = F.shiftright((F.shiftright(tie, 32) + (1 << 31)) * null_chunks, 32)
    below = _first_not_below(listed, F.col(key), F.lit(len(bounds))) if bounds else F.lit(0)
    chunk = F.when(F.col(key).isNull(), len(bounds) + 1 + range_of_tie).otherwise(len(bounds) - below).cast("int")
    placed = docs.withColumn("_chunk", chunk)
    # One row per chunk, so at most twice _MOST_CHUNKS.
    firsts = sorted((r["_chunk"], r["first"]) for r in placed.select("_chunk", key).groupBy("_chunk").agg(
        F.max(key).alias("first")).collect()) if n else []
    if not firsts:
        return derive(docs).select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    before = docs.sparkSession.createDataFrame(
        [(c, firsts[i - 1][0], first) for i, (c, first) in enumerate(firsts)],
        f"_chunk int, _before int, _first {docs.schema[key].dataType.simpleString()}")
    leading = (
        placed.join(F.broadcast(before), "_chunk").where(F.col(key).eqNullSafe(F.col("_first")))
        .groupBy("_before").agg(F.min_by(F.struct(*docs.columns), tie).alias("row"))
        .select("row.*", F.col("_before").alias("_chunk"), F.lit(1).alias("_extra"))
    )
    order = Window.partitionBy("_chunk").orderBy("_extra", F.col(key).desc_nulls_last(), tie)
    both = derive(placed.withColumn("_extra", F.lit(0))).unionByName(derive(leading))
    return both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where(
        "_extra = 0").drop("_chunk", "_extra")


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row's whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       as_text(sketch(F.col("text"))).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last third replaced by the beginning of the next document.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("tie"), F.length("text").cast("long").alias("n_chars"))
    pairs = with_next(own, "doc_id", "tie", ["text", "sketch"],
                      lambda rows: rows.withColumn("sketch", sketch(F.col("text"))))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = pairs.withColumn("edited", F.concat(
        F.left("text", F.col("n_chars").cast("int") - cut), F.left("next_text", cut)))
    sketched = edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch",
        sketch(F.col("edited")).alias("edited_sketch"))
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
