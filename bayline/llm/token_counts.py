"""Token counts by byte-pair merging, without producing token ids.

Each pre-token is a linked list of symbols and a heap of its adjacent pairs. The pair of lowest
rank is popped and merged until no known pair is left; the count is the number of initial
symbols minus the number of merges. Pre-tokens repeat, so a task keeps the counts it has found in
a bounded table.

Defined cases: null and empty texts have 0 tokens and 0 bytes; every input row gives one output
row, so null ids, repeated rows and extra columns change nothing; an empty table gives an empty
result. A pre-token of any length takes O(n log n) steps. Strings of the vocabulary's own special
tokens count as one token each, as the library's default has it.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "byte_bpe_50k.json"
OVER = 1024
_KNOWN_WORDS = 400_000
_KNOWN_LENGTH = 64
_SHIFT = 20

# Fixed value: the pre-token pattern of byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    shown = {b: chr(b) for b in plain}
    return [shown.get(b) or chr(next(spare)) for b in range(256)]


def load_merges(path: str) -> tuple[list[int], dict[int, int], list[str]]:
    """Symbol of each byte, (left, right) -> (rank, merged symbol) as packed ints, special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids = spec["model"]["vocab"]
    pairs = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.setdefault(ids[left] << _SHIFT | ids[right], rank << _SHIFT | ids[left + right])
    return [ids[c] for c in byte_alphabet()], pairs, [t["content"] for t in spec["added_tokens"]]


def count_merged(word: bytes, symbol: list[int], pairs: dict[int, int]) -> int:
    """Tokens of one pre-token."""
    n = len(word)
    if n < 2:
        return n
    syms = [symbol[b] for b in word]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = pairs.get(syms[i] << _SHIFT | syms[i + 1])
        if found is not None:
            heap.append((found, i))
    heapq.heapify(heap)
    merges = 0
    while heap:
        found, i = heapq.heappop(heap)
        j = after[i]
        # Entries of symbols that have changed since are out of date.
        if syms[i] < 0 or j >= n or pairs.get(syms[i] << _SHIFT | syms[j]) != found:
            continue
        merges += 1
        syms[i], syms[j] = found & ((1 << _SHIFT) - 1), -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = pairs.get(syms[i] << _SHIFT | syms[k])
            if found is not None:
                heapq.heappush(heap, (found, i))
        h = before[i]
        if h >= 0:
            found = pairs.get(syms[h] << _SHIFT | syms[i])
            if found is not None:
                heapq.heappush(heap, (found, h))
    return n - merges


class TextCounter:
    """Counts the tokens of whole texts; remembers a bounded number of short pre-tokens."""

    def __init__(self, path: str):
        self.symbol, self.pairs, special = load_merges(path)
        self.words = regex.compile(PRE_TOKEN).findall
        longest_first = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        n = count_merged(word.encode("utf-8"), self.symbol, self.pairs)
        if len(word) <= _KNOWN_LENGTH:
            self.known[word] = n
        return n

    def plain(self, text: str) -> int:
        words = self.words(text)
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        known = self.known.get
        return sum(known(w) or self.word(w) for w in words)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


def token_counts(docs: DataFrame, vocabulary: str | None = None, over: int = OVER) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    `vocabulary` is the path of a byte-level BPE file, as executors see it.
    """
    def counted(batches):
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        count = TextCounter(path)
        for batch in batches:
            n = pa.array([count(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select(
        F.col("doc_id").cast("long"), "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return texts.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > over)
