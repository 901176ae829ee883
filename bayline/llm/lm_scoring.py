"""Language-model scores from a log-frequency Bloom filter.

`fit` counts the words and word pairs of the training documents over the whole corpus and stores
them as a filter. An n-gram that occurs c times has the level 1 + floor(log2 c) and enters the
filter once for each level up to its own. The filter has `EVENT_BITS` per entry, however many
entries there are: it is a table of segments, one for each range of the hash, of bounded size each.
Beside them lie the exact counts of the words, for the unigram score. Such a model can be kept and
opened again.

`score` probes a model for any documents: levels 1, 2, ... of an n-gram until the first that is
missing; the count is the middle of the last one found. As the whole filter has no bound, it isn't
broadcast: each block of documents asks the ranges of its n-grams, and a task that answers holds one
segment. The probability of a word is the mean of count(pair) / count(word before) and of
(count + 1) / (N + V + 1).

Texts are coded in blocks of about `BLOCK` tokens: the sorted distinct word hashes of the block and,
for each token, its place among them. Blocks send sorted runs of n-gram hashes to the ranges: without
a row per token and without any task that holds the vocabulary. Ranges grow in number with the
training tokens, about `RANGE` tokens to one, so a range doesn't grow. A run goes from one block to
one range; beyond 64 ranges runs get shorter, at most to single n-grams, so that what is sent never
grows faster than the n-grams.

Defined cases: null and empty texts are the end token alone; a null id counts as the empty text for
the fold, so such a document trains; without training documents all counts are 0; every input row
gives one output row, repeated rows equal ones; extra columns are ignored; an empty table gives an
empty result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bayline.llm.common import prepare, remainder, stage
from bayline.llm.words import Words, mixed
from bayline.session import scratch_path

FOLDS, HELD_OUT = 7, 2
BLOCK = 1 << 20
RANGE = 1 << 22
EVENT_BITS = 8
PROBES = 4
MOST_LEVELS = 40
_END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def packed(values: np.ndarray, ordered: bool = False) -> bytes:
    """Non-negative integers as compressed planes of their bytes; of an ordered array, its steps."""
    values = values.astype(np.uint64)
    if ordered:
        values = np.diff(values, prepend=np.uint64(0))
    planes = values.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes, ordered: bool = False) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * size, "zstd"), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return np.cumsum(values) if ordered else values


def encoded(docs: DataFrame, trains: Column | None = None) -> DataFrame:
    """One row per block: its documents, their token numbers, their tokens as places in `words`.

    `trains` tells the documents that a model may learn from: all, unless given.
    """
    block_size = BLOCK
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
        ("trains", pa.list_(pa.bool_())), ("words", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])

    def coded(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        words = Words()
        block = TaskContext.get().partitionId() << 32
        ids, learnt, sizes, parts, held = [], [], [], [], 0

        def row():
            number, trains = np.concatenate(sizes), np.array(learnt, bool)
            distinct, places = np.unique(np.concatenate(parts), return_inverse=True)
            counts = np.bincount(places[np.repeat(trains, number)], minlength=len(distinct))
            return pa.RecordBatch.from_pylist([{
                "block": block, "doc_ids": ids, "n_tokens": number, "trains": trains,
                "words": packed(distinct, ordered=True), "counts": packed(counts),
                "tokens": packed(places)}], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, number = words(batch.column("text").to_pylist())
            # The end token follows the words of each document.
            parts.append(np.insert(hashes, np.cumsum(number), _END))
            sizes.append(number + 1)
            ids += batch.column("doc_id").to_pylist()
            learnt += batch.column("trains").to_pylist()
            held += len(parts[-1])
            if held >= block_size:
                yield row()
                ids, learnt, sizes, parts, held = [], [], [], [], 0
                block += 1
        if ids:
            yield row()

    trains = F.lit(True) if trains is None else F.coalesce(trains, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", trains.alias("trains")).mapInArrow(
        coded, "block long, doc_ids array<long>, n_tokens array<long>, trains array<boolean>, "
               "words binary, counts binary, tokens binary")


def ranges(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2**bits equal ranges of the hash begins in a sorted array, and its end."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def pair_hashes(tokens: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Hash of each token and the one before it; the start marker comes before a document.

    The lowest bits are left out: the filter errs more often than 48 bits do, and they cost space.
    """
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(number) - number] = _START
    return mixed(before * _PAIR + tokens) >> np.uint64(16) << np.uint64(16)


SENT = pa.schema([("pairs", pa.bool_()), ("range", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()),
                  ("counts", pa.binary())])
_SENT = "pairs boolean, range int, block long, hashes binary, counts binary"


def sent(blocks: DataFrame, bits: int, training: bool) -> DataFrame:
    """The distinct words and pairs of each block, in a run for each range.

    For training, those of the training documents with their counts; otherwise all, without.
    """
    def runs(block: int, pairs: bool, hashes: np.ndarray, counts: np.ndarray | None):
        if training:
            hashes, counts = hashes[counts > 0], counts[counts > 0]
        at = ranges(hashes, bits)
        for r in np.flatnonzero(np.diff(at)).tolist():
            part = slice(at[r], at[r + 1])
            yield {"pairs": pairs, "range": r, "block": block, "hashes": packed(hashes[part], ordered=True),
                   "counts": packed(counts[part]) if training else None}

    def dealt(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                words, number = unpacked(row["words"], ordered=True), np.array(row["n_tokens"])
                rows += runs(row["block"], False, words, unpacked(row["counts"]).astype(np.int64))
                hashes = pair_hashes(words[unpacked(row["tokens"])], number)
                if training:
                    hashes = hashes[np.repeat(np.array(row["trains"], bool), number)]
                rows += runs(row["block"], True, *np.unique(hashes, return_counts=True))
                yield pa.RecordBatch.from_pylist(rows, SENT)

    return blocks.select("block", "words", "counts", "tokens", "n_tokens", "trains").mapInArrow(dealt, _SENT)


def summed(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sum of the counts of each."""
    distinct, places = np.unique(np.concatenate(words), return_inverse=True)
    return distinct, np.bincount(places, np.concatenate(counts), len(distinct)).astype(np.int64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c)."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], MOST_LEVELS)


def middle(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the mean of its smallest and its largest; 0 for none."""
    low = np.exp2(levels - 1.0)
    return np.where(levels > 0, (3 * low - 1) / 2, 0.0)


def places(hashes: np.ndarray, level: int, size: int) -> Iterator[np.ndarray]:
    """The bits of (n-gram, level) entries in a segment of `size` bits."""
    first = mixed(hashes + np.uint64(level * int(_PAIR) % (1 << 64)))
    step = mixed(first) | np.uint64(1)
    for k in range(PROBES):
        yield ((first + np.uint64(k) * step) >> np.uint64(20)) % np.uint64(size)


def segment(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Filter of one range of n-grams."""
    levels = levels_of(counts)
    size = max(64, -(-int(levels.sum()) * EVENT_BITS // 64) * 64)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for at in places(hashes[levels >= level], level, size):
            bits[at] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Segment:
    """Quantised counts of n-grams by repeated probes of one range's filter."""

    def __init__(self, data: bytes):
        self.data, self.size = np.frombuffer(data, np.uint8), 8 * len(data)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The last level whose entry, and that of all before, is found."""
        found = np.zeros(len(hashes), np.int64)
        left = np.arange(len(hashes))
        for level in range(1, MOST_LEVELS + 1):
            if not len(left):
                break
            hit = np.ones(len(left), bool)
            for at in places(hashes[left], level, self.size):
                hit &= (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            left = left[hit]
            found[left] = level
        return found


SEGMENTS = pa.schema([
    ("pairs", pa.bool_()), ("range", pa.int32()), ("filter", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()),
    ("tokens", pa.int64()), ("distinct", pa.int64())])
_SEGMENTS = ("pairs boolean, range int, filter binary, words binary, counts binary, tokens long, distinct long")


@dataclass(frozen=True)
class Model:
    """A stored filter: (pairs, range, filter), and for words their exact counts.

    A segment is bounded by its range: about `RANGE` tokens, so some 10 MB at most.
    """

    segments: DataFrame
    bits: int
    tokens: int
    distinct: int


def open_model(spark: SparkSession, path: str) -> Model:
    """A model that `fit` has stored."""
    bits = spark.read.schema("bits int").parquet(f"{path}/bits").first()["bits"]
    segments = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    tokens, distinct = segments.where("not pairs").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    return Model(segments, bits, tokens, distinct)


def fit_blocks(blocks: DataFrame, path: str | None = None) -> Model:
    """The model of stored blocks."""
    def merged(group: pa.Table) -> pa.Table:
        hashes, counts = summed([unpacked(w, ordered=True) for w in group.column("hashes").to_pylist()],
                                [unpacked(c) for c in group.column("counts").to_pylist()])
        pairs = group.column("pairs")[0].as_py()
        return pa.Table.from_pylist([{
            "pairs": pairs, "range": group.column("range")[0].as_py(), "filter": segment(hashes, counts),
            "words": None if pairs else packed(hashes, ordered=True), "counts": None if pairs else packed(counts),
            "tokens": int(counts.sum()), "distinct": len(hashes)}], SEGMENTS)

    spark = blocks.sparkSession
    size = blocks.select(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda n, x: n + x).alias("n")).agg(
        F.sum("n")).first()[0] or 0
    bits = max(6, math.ceil(math.log2(max(1, size) / RANGE)))
    path = path or scratch_path(spark, "lm")
    sent(blocks, bits, True).groupBy("pairs", "range").applyInArrow(merged, _SEGMENTS).write.parquet(f"{path}/segments")
    spark.range(1).select(F.lit(bits).cast("int").alias("bits")).write.parquet(f"{path}/bits")
    return open_model(spark, path)


def fit(docs: DataFrame, path: str | None = None) -> Model:
    """Learn from all rows of `docs` and store the model at a new path."""
    prepare(docs.sparkSession)
    return fit_blocks(stage(encoded(docs), "blocks"), path)


ANSWERS = pa.schema([("block", pa.int64()), ("range", pa.int32()), ("pairs", pa.bool_()), ("levels", pa.binary()),
                     ("exact", pa.binary())])
_ANSWERS = "block long, range int, pairs boolean, levels binary, exact binary"


def answers(asked: DataFrame, model: Model) -> DataFrame:
    """For each run that was sent, the levels of its n-grams; for words also the exact counts."""
    def probed(left: pa.Table, right: pa.Table) -> pa.Table:
        held = right.to_pylist()[0] if right.num_rows else None
        told = Segment(held["filter"]) if held else None
        words = counts = np.zeros(0, np.uint64)
        if held and not held["pairs"]:
            words, counts = unpacked(held["words"], ordered=True), unpacked(held["counts"])
        rows = []
        for run in left.select(["block", "range", "pairs", "hashes"]).to_pylist():
            hashes = unpacked(run["hashes"], ordered=True)
            levels = told.levels(hashes) if told else np.zeros(len(hashes), np.int64)
            exact = None
            if not run["pairs"]:
                at = np.searchsorted(words, hashes)
                inside = at < len(words)
                inside[inside] = words[at[inside]] == hashes[inside]
                exact = np.zeros(len(hashes), np.int64)
                exact[inside] = counts[at[inside]]
                exact = packed(exact)
            rows.append({"block": run["block"], "range": run["range"], "pairs": run["pairs"], "levels": packed(levels),
                         "exact": exact})
        return pa.Table.from_pylist(rows, ANSWERS)

    keys = ["pairs", "range"]
    return asked.groupBy(*keys).cogroup(model.segments.groupBy(*keys)).applyInArrow(probed, _ANSWERS)


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def score_blocks(blocks: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of the documents in stored blocks."""
    floor = model.tokens + model.distinct + 1

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        block = left.slice(0, 1).to_pylist()[0]
        number = np.array(block["n_tokens"], np.int64)
        starts = np.cumsum(number) - number
        distinct, tokens = unpacked(block["words"], ordered=True), unpacked(block["tokens"]).astype(np.int64)

        def joined(column: str, pairs: bool) -> np.ndarray:
            some = right.filter(pc.equal(right.column("pairs"), pairs)).sort_by("range").column(column)
            return np.concatenate([unpacked(d) for d in some.to_pylist()]).astype(np.int64)

        exact = joined("exact", False)
        base = np.log10((exact + 1) / floor)
        one = middle(joined("levels", False))
        alone = (one + 1) / floor
        # A pair is looked up once per block.
        at = np.unique(pair_hashes(distinct[tokens], number), return_inverse=True)[1]
        both = middle(joined("levels", True))[at]
        before = np.empty(len(tokens))
        before[1:] = one[tokens[:-1]]
        before[starts] = one[np.searchsorted(distinct, _END)]  # as many starts as ends
        # No pair is more frequent than its words, so such a count is an error of the filter.
        both = np.minimum(both, np.minimum(before, one[tokens]))
        chance = (both / np.maximum(before, 1) + alone[tokens]) / 2
        return pa.table({
            "doc_id": pa.array(block["doc_ids"], pa.int64()), "n_tokens": number,
            "n_known": np.add.reduceat((exact > 0)[tokens].astype(np.int64), starts),
            "base_score": np.add.reduceat(base[tokens], starts),
            "score": np.add.reduceat(np.log10(chance), starts)})

    told = answers(sent(blocks, model.bits, False), model)
    wanted = blocks.select("block", "doc_ids", "n_tokens", "words", "tokens")
    return wanted.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(scored, SCORED)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score any documents by a model, whether or not it has seen them."""
    prepare(docs.sparkSession)
    return score_blocks(stage(encoded(docs), "blocks"), model)


def scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from the documents that aren't held out.
    """
    prepare(docs.sparkSession)
    held_out = remainder(F.col("doc_id").cast("long"), FOLDS) == HELD_OUT
    blocks = stage(encoded(docs, ~held_out), "blocks")
    model = fit_blocks(blocks)
    return score_blocks(blocks, model).select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"), "base_score", "score")
