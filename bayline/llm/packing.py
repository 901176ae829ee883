"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

A document is its token ids and a closing id. Documents longer than a sequence are cut into full
sequences and a rest; every other piece stays whole. Pieces are dealt at random into groups of
about `GROUP` sequences' worth of tokens, and each group is packed on its own, longest piece first:
a piece goes to the open sequence whose choice leaves the smallest sum, over all residual gaps, of
the squared number of open sequences with that gap. A sequence is opened only where no open one has
room. A group wastes about one sequence, one in `GROUP` (more only where a group is bounded by its
`GROUP_PIECES`: pieces of less than 16 tokens), and its size doesn't grow with the input.

Defined cases: null and empty texts are the closing id alone; every row is packed, so repeated
rows and null ids keep all their pieces (their row keys differ); ties go to the fullest sequence
and pieces of equal length keep the order of their row keys; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bayline.llm.common import prepare, stage, worker_memo
from bayline.llm.token_counts import byte_alphabet

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
GROUP = 2048
GROUP_PIECES = 1 << 18
_KNOWN_CHUNKS = 400_000
_KNOWN_LENGTH = 64
# Signs that may follow a word; letters below the second are the same composed or not.
_SIGNS = ".,!?|;:#$%&*"
_AFTER_LATIN = "\u0100"
_SHOWN = dict(enumerate(byte_alphabet()))
# Python's split takes these for white space, the vocabulary's normaliser doesn't.
_SEPARATORS = re.compile("[\x1c-\x1f]")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row_key long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class ChunkEncoder:
    """Ids of whole texts.

    The vocabulary drops white space and never joins across it, so the ids of a text are those of
    its chunks one after the other; nor does it join a letter and a sign, so a word and the signs
    after it can be looked up apart. A bounded number of short chunks is remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For words that need no normalising, the same model without the steps before it.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        ids = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        self.ends[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        # Ids as bytes of little-endian unsigned 32-bit numbers.
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of small letters: one call, since the last token of a word shows its end."""
        shown = " ".join(w if w.isascii() else w.encode("utf-8").decode("latin-1").translate(_SHOWN) for w in words)
        ids = np.asarray(self.letters.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
        stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(stops) != len(words):
            return self.encode(words)
        data, starts = ids.tobytes(), [0, *stops[:-1].tolist()]
        return [data[i:j] for i, j in zip(starts, stops.tolist())]

    def encode_all(self, chunks: list[str], how, into: dict[str, bytes]) -> None:
        for at in range(0, len(chunks), 4096):
            some = chunks[at:at + 4096]
            into.update(zip(some, how(some)))

    def learn(self, missing: set[str], into: dict[str, bytes]) -> None:
        """Ids of the chunks; a word followed by signs is put together from both."""
        put, odd, words, ends = [], [], set(), set()
        known = self.known
        for chunk in missing:
            word = chunk.rstrip(_SIGNS)
            if word.isalpha() and (word.isascii() or max(word) < _AFTER_LATIN):
                small = word.lower()
                if small not in known:
                    words.add(small)
                if small != chunk:
                    signs = chunk[len(word):]
                    put.append((chunk, small, signs))
                    ends.add(signs)
            else:
                odd.append(chunk)
        own: dict[str, bytes] = {}
        self.encode_all(list(words), self.encode_words, own)
        into.update(own)
        own[""] = b""
        self.encode_all(odd + [c for c in ends if c], self.encode, own)
        into.update((chunk, own[chunk]) for chunk in odd)
        into.update((chunk, (own.get(word) or known[word]) + own[signs]) for chunk, word, signs in put)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > _KNOWN_CHUNKS:
            self.known.clear()
        chunks = [[] if not t else [t] if _SEPARATORS.search(t) else t.split() for t in texts]
        # One look-up a different chunk, then one an occurrence, both inside the interpreter's own loops.
        missing = set().union(*chunks).difference(self.known)
        once: dict[str, bytes] = {}
        long = {c for c in missing if len(c) > _KNOWN_LENGTH}
        self.learn(missing - long if long else missing, self.known)
        if not long:
            return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4") for words in chunks]
        self.learn(long, once)
        return [np.frombuffer(b"".join([
            once[w] if w in once else self.known[w] for w in words]), "<u4") for words in chunks]


def cut(ids: np.ndarray, capacity: int):
    """(piece, start, length, crc32 of the ids as little-endian 32-bit numbers)."""
    for piece, start in enumerate(range(0, len(ids), capacity)):
        part = ids[start:start + capacity]
        yield piece, start, len(part), zlib.crc32(part.tobytes())


def pieces(docs: DataFrame, vocabulary: str | None, end_id: int, capacity: int) -> DataFrame:
    """The pieces of all documents. row_key differs between any two rows of `docs`."""
    end = np.asarray([end_id], "<u4")
    memo = worker_memo(docs.sparkSession)

    def tokenised(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        encode = memo.value.get(path) or memo.value.setdefault(path, ChunkEncoder(path))
        row = TaskContext.get().partitionId() << 36
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids_crc32", pa.int64()), ("row_key", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                out += [(doc_id, *part, row) for part in cut(np.append(ids, end), capacity)]
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenised, PIECES)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (from 0) and offset of each length, which must come in descending order."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by fill
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, size in enumerate(lengths.tolist()):
        room = count[1:capacity - size + 1]
        fill = 0
        if room.any():
            # Change of the sum of squares if a sequence of that fill takes the piece; a full
            # sequence leaves the sum, so nothing is added for it.
            change = 2 * (count[size + 1:capacity + 1] - room) + 2
            change[-1] = 1 - 2 * room[-1]
            change[room == 0] = np.iinfo(np.int64).max
            fill = len(change) - int(change[::-1].argmin())
        if fill:
            chosen = open_at[fill].pop()
            count[fill] -= 1
        else:
            chosen, opened = opened, opened + 1
        sequence[i], offset[i] = chosen, fill
        if fill + size < capacity:
            open_at[fill + size].append(chosen)
            count[fill + size] += 1
    return sequence, offset


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0,
         capacity: int = CAPACITY, group: int = GROUP, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: where it starts in its document and where it lies in which sequence."""
    prepare(docs.sparkSession)
    cuts = stage(pieces(docs, vocabulary, end_id, capacity), "pieces")
    # Groups of a bounded size, however much there is to pack.
    number, tokens = cuts.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    groups = max(1, -(-tokens // (group * capacity)), -(-number // group_pieces))

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "row_key", "piece"], ascending=[False, True, True], kind="stable")
        sequence, part["offset"] = place(part["length"].to_numpy(), capacity)
        part["sequence_id"] = part["_group"].to_numpy(np.int64) << 32 | sequence
        return part[[c.split()[0] for c in PACKED.split(", ")]]

    dealt = cuts.withColumn("_group", F.pmod(F.xxhash64("row_key", "piece"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(packed, PACKED)
