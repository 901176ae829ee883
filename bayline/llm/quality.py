"""Quality classifier on supervised subword embeddings.

Every word and every character n-gram of a word (with its boundaries) is hashed to a bucket; a
bucket has a learned vector, a document is the mean of the vectors of all its features (and of
`BLANK` zero vectors, which hold very short texts back), and a softmax over two outputs gives the
score. A word that repeats the word before it is read as one special word. Numpy stochastic gradient descent fits vectors and
outputs on a bounded, class-balanced sample of labelled documents (`SAMPLE` per class, chosen by a
hash of the text over all labelled rows); the scores are then set back to the class shares counted
over all labelled rows.

Since the mean comes before the linear output, vectors and outputs fold into one number per
bucket, so scoring is a lookup and a mean over the whole text.

Defined cases: null and empty texts have no features and get the score of the class shares alone;
labels other than 0 and 1 and null ids or labels teach nothing; a document with several labels
counts as 0 if any is 0; without labels, or with one class only, every score is 0.5 or that
class's share (smoothed). Every row is scored on its own, so repeated rows score alike; extra
columns are ignored; an empty table gives an empty result. Texts are read in slices cut at white
space, of whole words however long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bayline.llm.common import prepare, remainder
from bayline.llm.words import Words, grouped

SAMPLE = 2000
BUCKET_BITS = 17
WIDTH = 16
EPOCHS = 12
RATE = 4.0
BATCH = 16
NGRAMS = (3, 4)
BLANK = 10
ACCEPT = 0.3
FOLDS = 5


class Features:
    """Buckets of all words and character n-grams of a list of texts."""

    def __init__(self, bits: int = BUCKET_BITS, ngrams: tuple[int, ...] = NGRAMS):
        self.shift, self.ngrams, self.words = np.uint64(64 - bits), ngrams, Words()

    def bucket(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        hashes = (hashes + np.uint64(kind * 0x632BE59BD9B4E019 % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(32)
        return (hashes * np.uint64(0xC2B2AE3D27D4EB4F) >> self.shift).astype(np.int32)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets, and the number of the text that each belongs to."""
        codes, space = self.words.codes(texts)
        codes[space] = 32
        ends = np.cumsum([len(t) + 1 for t in texts])
        buckets, places = [], []
        starts, stops = self.words.spans(space)
        words = self.words.hashes(codes, starts, stops)
        owner = np.searchsorted(ends, starts, "right")
        again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1])) + 1
        words = self.bucket(words, 0)
        words[again] = self.bucket(np.zeros(1, np.uint64), 1)
        buckets.append(words)
        places.append(starts)
        inside = ~space
        for n in self.ngrams:
            hashes = codes[:len(codes) - n + 1].copy()
            for k in range(1, n):
                hashes = hashes * np.uint64(0x100000001B3) + codes[k:len(codes) - n + 1 + k]
            whole = inside[1:len(codes) - n + 2].copy()
            for k in range(2, n - 1):
                whole &= inside[k:len(codes) - n + 1 + k]
            at = np.flatnonzero(whole)
            buckets.append(self.bucket(hashes[at], n))
            places.append(at + 1)
        owner = [np.searchsorted(ends, p, "right") for p in places]
        return np.concatenate(buckets), np.concatenate(owner)


@dataclass
class Model:
    """Folded weights: the logit is `bias` plus the mean weight of a text's features."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None], features: Features) -> np.ndarray:
        total, number = np.zeros(len(texts)), np.zeros(len(texts))
        for some in grouped(texts):
            buckets, owner = features([part for _, part in some])
            row = np.array([i for i, _ in some])
            np.add.at(total, row, np.bincount(owner, self.weights[buckets], len(some)))
            np.add.at(number, row, np.bincount(owner, minlength=len(some)))
        logit = self.bias + total / (number + BLANK)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def descend(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, epochs: int = EPOCHS,
            rate: float = RATE, seed: int = 7) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent on (buckets, shares, label) rows; the folded weights and bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (size, WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    steps, step = epochs * -(-len(rows) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            some = [rows[i] for i in order[at:at + BATCH]]
            speed = rate * (1 - step / steps) / len(some)
            step += 1
            means = np.stack([share @ vectors[buckets] for buckets, share, _ in some])
            logits = means @ out + bias
            error = np.exp(logits - logits.max(1, keepdims=True))
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(some)), [label for *_, label in some]] -= 1
            back = error @ out.T
            out -= speed * means.T @ error
            bias -= speed * error.sum(0)
            for (buckets, share, _), g in zip(some, back):
                vectors[buckets] -= speed * share[:, None] * g
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def learning_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of the sample, and the labelled rows of each class outside the held-out fold."""
    label = F.col("quality").cast("int")
    known = labels.where(
        F.col("doc_id").isNotNull() & label.isin(0, 1) & (remainder(F.col("doc_id"), FOLDS) != 0)
    ).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).alias("_label"))
    per_class = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    # A uniform draw over different texts: the unsigned top bits of a hash of the text.
    draw = F.shiftrightunsigned(F.xxhash64("text"), 24)
    share = F.lit(0.0)
    for value, n in per_class.items():
        share = F.when(F.col("_label") == value, min(1.0, SAMPLE / n)).otherwise(share)
    chosen = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), draw.alias("_draw"))
        .join(known, "doc_id")
        .where(F.col("_draw") < share * float(1 << 40))
        # Copies of a text teach once.
        .groupBy("_draw", "_label").agg(F.min("doc_id").alias("doc_id"))
        .orderBy("_draw", "_label").limit(3 * SAMPLE)
    )
    return chosen.select("doc_id", "_label"), per_class


def fit(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS) -> Model:
    """Learn from the labelled documents outside the held-out fold."""
    prepare(docs.sparkSession)
    chosen, per_class = learning_rows(docs, labels)
    size = 1 << BUCKET_BITS
    share = {c: (per_class.get(c, 0) + 1) / (sum(per_class.values()) + 2) for c in (0, 1)}
    prior = float(np.log(share[1] / share[0]))
    if min(per_class.get(0, 0), per_class.get(1, 0)) == 0:
        return Model(np.zeros(size, np.float32), prior)

    def counted(batches):
        features = Features()
        for batch in batches:
            found: list[dict] = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("_label").to_pylist()):
                total = np.zeros(size, np.float32)
                for some in grouped([text]):
                    total += np.bincount(features([part for _, part in some])[0], minlength=size)
                at = np.flatnonzero(total).astype(np.int32)
                found.append({"_label": label, "buckets": at.tobytes(),
                              "shares": (total[at] / (total.sum() + BLANK)).astype(np.float32).tobytes()})
            yield pa.RecordBatch.from_pylist(found, pa.schema(
                [("_label", pa.int32()), ("buckets", pa.binary()), ("shares", pa.binary())]))

    # `chosen` has at most 3 * SAMPLE rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id").select("text", "_label")
    sample = texts.mapInArrow(counted, "_label int, buckets binary, shares binary").limit(4 * SAMPLE).collect()
    rows = sorted(((bytes(r["buckets"]), bytes(r["shares"]), r["_label"]) for r in sample))
    rows = [(np.frombuffer(b, np.int32), np.frombuffer(s, np.float32), label) for b, s, label in rows]
    # Balanced: as many steps with either class; the class shares come back through the bias.
    by = {c: [r for r in rows if r[2] == c] for c in (0, 1)}
    if not by[0] or not by[1]:
        return Model(np.zeros(size, np.float32), prior)
    most = max(map(len, by.values()))
    balanced = [r for c in (0, 1) for r in (by[c] * -(-most // len(by[c])))[:most]]
    weights, bias = descend(balanced, size, epochs)
    return Model(weights, bias + prior)


def score(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    prepare(docs.sparkSession)

    def scored(batches):
        features = Features()
        for batch in batches:
            found = model.scores(batch.column("text").to_pylist(), features)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scored, "doc_id long, score double"
    ).select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
             (F.col("score") >= accept).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The rows, with all their columns, whose score reaches `accept`."""
    prepare(docs.sparkSession)

    def kept(batches):
        features = Features()
        for batch in batches:
            found = model.scores(batch.column("text").to_pylist(), features)
            yield batch.filter(pa.array(found >= accept))

    return docs.mapInArrow(kept, docs.schema)
