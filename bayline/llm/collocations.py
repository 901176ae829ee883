"""Phrases of two to four words whose words keep together, language by language.

Only the longest windows are counted: at each word, the word and the three that lead from it, padded
with '' behind the end of a piece. Spark's ROLLUP then sums the windows' counts over successively
shorter prefixes, so every phrase's count is the sum of the windows that begin with it, and the
language's own sum is its number of words.

Partitions cut their text into blocks, number the words of a block and count its distinct windows;
these are dealt by the window's first two words to about one range for each `RANGE_BYTES` of text,
as compressed arrays. All windows of a word pair meet there, so tails that can't belong to a phrase
of `least` occurrences are padded away before the ROLLUP: nothing is lost, as the prefixes keep
their sums. A pair with very many different windows in some block is dealt by the whole window
instead; a marker tells its range, and its windows are left as they are. Thus no task gets all
windows of a frequent pair.

Defined cases: a null text is empty, a null language `und`; every row counts, so repeated rows count
again and ids don't matter; phrases never cross a piece, whatever the length of the text (it is read
in slices that windows reach across); ties as the contract has them, phrases by their UTF-8 bytes;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from bayline.llm.common import prepare, stage
from bayline.llm.words import mixed
from bayline.operators.ranking import top_n_per_group

LONGEST = 4
LEAST = 30
MOST = 2000
COVERED = 80
BLOCK = 1 << 20
RANGE_BYTES = 16_000_000
_SLICE = 1 << 20
# A block's codes fit into so many bits: a slice is at most one token for each of its bytes.
_CODE_BITS = 21
_SEPARATOR = b"."
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _SEPARATORS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_SEPARATORS))
_BLANK = re.compile(rb"[ \n]")
_HOT_LEAST = 64

COUNTED = "lang string, w1 string, w2 string, w3 string, w4 string, n long"


class Codes(dict):
    """Numbers words in the order in which they come; what stands for "no word" has number 0."""

    def __init__(self, nothing: bytes):
        super().__init__({nothing: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text and separators, slice after slice; no word is cut."""
    at = 0
    folded = text.translate(_FOLD)
    while at < len(folded):
        cut = _BLANK.search(folded, at + _SLICE) if len(folded) - at > _SLICE else None
        stop = cut.start() if cut else len(folded)
        part = folded if stop - at == len(folded) else folded[at:stop]
        yield part.replace(b"\n", b" . ").split()
        at = stop


def lead_windows(codes: np.ndarray) -> list[np.ndarray]:
    """The word at each place and the three that lead from it; 0 once a piece has ended."""
    padded = np.concatenate([codes, np.zeros(LONGEST - 1, np.int64)])
    columns = [codes]
    for k in range(1, LONGEST):
        columns.append(np.where(columns[-1] == 0, 0, padded[k:k + len(codes)]))
    at = codes != 0
    return [c[at] for c in columns]


def packed_windows(words: list[bytes], columns: list[np.ndarray]) -> bytes:
    """Windows as codes of the given words, with their numbers and marks, compressed."""
    text = b"\n".join(words)
    planes = np.stack([c.astype("<u4") for c in columns])
    planes[0] = np.diff(planes[0], prepend=np.uint32(0))
    # Byte planes: most bytes of the numbers are zero.
    planes = np.ascontiguousarray(planes.view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1)).tobytes()
    sizes = np.array([len(text), len(columns[0])], "<u8").tobytes()
    return sizes + pa.compress(text + planes, "zstd", asbytes=True)


def unpacked_windows(data: bytes) -> tuple[list[bytes], np.ndarray]:
    length, number = np.frombuffer(data[:16], "<u8").tolist()
    size = 4 * (LONGEST + 2)
    data = pa.decompress(data[16:], length + size * number, "zstd", asbytes=True)
    planes = np.frombuffer(data, np.uint8, offset=length).reshape(LONGEST + 2, 4, number)
    columns = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4").reshape(LONGEST + 2, number).astype(np.int64)
    columns[0] = np.cumsum(columns[0]) & 0xFFFFFFFF
    return data[:length].split(b"\n"), columns


def block_windows(vocabulary: Codes, codes: np.ndarray, complete: int, ranges: int, hot: int):
    """(range, data) of the windows that begin at the first `complete` places of a block."""
    words = list(vocabulary)
    order = sorted(range(1, len(words)), key=words.__getitem__)
    words = [b""] + [words[i] for i in order]
    rank = np.zeros(len(words), np.int64)
    rank[order] = np.arange(1, len(words))
    # Places behind the complete ones only lead; as separators they begin no window.
    columns = lead_windows(rank[codes])
    if complete < len(codes):
        columns = [c[:np.count_nonzero(codes[:complete])] for c in columns]
    if not len(columns[0]):
        return
    pairs, pair = np.unique(columns[0] << _CODE_BITS | columns[1], return_inverse=True)
    windows, n = np.unique(
        pair.astype(np.int64) << 2 * _CODE_BITS | columns[2] << _CODE_BITS | columns[3], return_counts=True)
    pair, code = windows >> 2 * _CODE_BITS, (1 << _CODE_BITS) - 1
    columns = [pairs[pair] >> _CODE_BITS, pairs[pair] & code, windows >> _CODE_BITS & code, windows & code]
    hashes = np.array([zlib.crc32(w) for w in words], np.uint64) << np.uint64(32)

    def dealt(first: np.ndarray, second: np.ndarray, salt=np.uint64(0)) -> np.ndarray:
        spot = mixed(mixed(hashes[first] + salt) + (hashes[second] >> np.uint64(32)))
        return ((spot >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)

    home = dealt(columns[0], columns[1])
    crowded = np.bincount(pair, minlength=len(pairs)) >= hot
    free = crowded[pair]
    if free.any():
        some = [c[free] for c in columns]
        home[free] = dealt(some[2], some[3], mixed(hashes[some[0]] + (hashes[some[1]] >> np.uint64(32))))
        marked = np.flatnonzero(crowded)
        marks = [pairs[marked] >> _CODE_BITS, pairs[marked] & code]
        home = np.concatenate([home, dealt(*marks)])
        nothing = np.zeros(len(marked), np.int64)
        columns = [np.concatenate(c) for c in zip(columns, [*marks, nothing, nothing])]
        n, free = np.concatenate([n, nothing]), np.concatenate([free, nothing == 0])
    order = np.lexsort((columns[0], home))
    columns = [c[order] for c in [*columns, n, free.astype(np.int64)]]
    edges = np.searchsorted(home[order], np.arange(ranges + 1))
    for r in range(ranges):
        some = [c[edges[r]:edges[r + 1]] for c in columns]
        if len(some[0]):
            used = np.unique(np.concatenate([[0], *some[:LONGEST]]))
            yield r, packed_windows([words[i] for i in used.tolist()],
                                    [np.searchsorted(used, c) for c in some[:LONGEST]] + some[LONGEST:])


def windows(docs: DataFrame, ranges: int, block: int = BLOCK) -> DataFrame:
    """(lang, range, data): the distinct windows of each block with their counts."""
    if block + _SLICE // 2 >= 1 << _CODE_BITS:
        raise ValueError("a block's words must fit into its codes")
    hot = max(_HOT_LEAST, block // (8 * ranges))
    schema = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("data", pa.binary())])

    def fold(batches: Iterator[pa.RecordBatch]):
        held: dict[str, tuple[Codes, list[np.ndarray]]] = {}
        size = 0

        def batch_of(lang, complete):
            vocabulary, parts = held[lang]
            found = list(block_windows(vocabulary, np.concatenate(parts), complete, ranges, hot))
            return pa.RecordBatch.from_arrays([
                pa.array([lang] * len(found), pa.string()), pa.array([r for r, _ in found], pa.int32()),
                pa.array([d for _, d in found], pa.binary())], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                carried: list[bytes] = []
                recent: list[bytes] = []
                for some in tokens(text):
                    vocabulary, parts = held.setdefault(lang, (Codes(_SEPARATOR), []))
                    parts.append(vocabulary.of(carried + some))
                    carried, recent = [], (recent + some)[1 - LONGEST:]
                    size += len(some)
                    if size < block:
                        continue
                    for other in list(held):
                        # The last words of an unfinished text begin their windows in the next block.
                        unfinished = len(recent) if other == lang else 0
                        yield batch_of(other, sum(map(len, held[other][1])) - unfinished)
                    carried, held, size = recent, {}, 0
                if carried or lang in held:
                    vocabulary, parts = held.setdefault(lang, (Codes(_SEPARATOR), []))
                    parts.append(vocabulary.of([*carried, _SEPARATOR]))
        for lang in held:
            yield batch_of(lang, sum(map(len, held[lang][1])))

    return docs.mapInArrow(fold, "lang string, range int, data binary")


def joined(group: list[np.ndarray], column: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows numbered by their group and column; the sum of `n` in each, and one row of each."""
    keys, first, place = np.unique(group << 32 | column, return_index=True, return_inverse=True)
    total = np.bincount(place, n, len(keys)).astype(np.int64)
    return place.astype(np.int64), total, first


def padded_windows(columns: np.ndarray, n: np.ndarray, free: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows and counts, with tails padded that can't be in a phrase of `least` occurrences."""
    level = np.ones(columns.shape[1], np.int64)
    place = columns[0]
    whole = None
    for k in range(1, LONGEST):
        place, total, first = joined(place, columns[k], n)
        if whole is None:
            whole = np.bincount(place, free, len(total))[place] > 0
        level[(columns[k] > 0) & (whole | (total[place] >= least))] = k + 1
    for k in range(1, LONGEST):
        columns[k][level <= k] = 0
    place = columns[0]
    for k in range(1, LONGEST):
        place, total, firsts = joined(place, columns[k], n)
    some = total > 0
    return columns[:, firsts[some]], total[some]


def counted(sent: DataFrame, least: int = LEAST) -> DataFrame:
    """The padded windows of each range and their counts."""
    schema = pa.schema([("lang", pa.string()), *((f"w{k}", pa.string()) for k in range(1, LONGEST + 1)), ("n", pa.int64())])

    def merge(group: pa.Table) -> pa.Table:
        vocabulary, parts = Codes(b""), []
        for data in group.column("data").to_pylist():
            words, columns = unpacked_windows(data)
            columns[:LONGEST] = vocabulary.of(words)[columns[:LONGEST]]
            parts.append(columns)
        columns = np.concatenate(parts, axis=1)
        kept, n = padded_windows(columns[:LONGEST], columns[LONGEST], columns[LONGEST + 1], least)
        words = pa.array(list(vocabulary), pa.binary()).cast(pa.string())
        lang = pa.array([group.column("lang")[0].as_py()] * len(n), pa.string())
        return pa.Table.from_arrays(
            [lang, *(words.take(pa.array(c)) for c in kept), pa.array(n, pa.int64())], schema=schema)

    return sent.groupBy("lang", "range").applyInArrow(merge, COUNTED)


def rolled_up(found: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, size, phrase, f) of all phrases with `least` occurrences; size 0: the language's words."""
    columns = [f"w{k}" for k in range(1, LONGEST + 1)]
    once = found.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    # grouping_id has a bit for each column left out, the last one's the lowest.
    sums = once.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    sums = sums.withColumn("size", F.lit(LONGEST) - F.bit_count("g"))
    last = F.element_at(F.array(F.lit("-"), *columns), (F.col("size") + 1).cast("int"))
    return sums.where(f"size >= 0 and (size = 0 or f >= {int(least)})").where(last != "").select(
        "lang", "size", F.concat_ws(" ", F.slice(F.array(*columns), F.lit(1), F.col("size"))).alias("phrase"), "f")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each phrase of two words and more, by its weakest cut."""
    candidates = phrases.where("size > 1")
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words")).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest"))
    sides = [phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(side))
             for part, side in (("first", "l"), ("rest", "r"))]
    cuts = cuts.join(sides[0], ["lang", "first"]).join(sides[1], ["lang", "rest"]).withColumn(
        "score", F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0))) div cast(l + r as decimal(19, 0))"))
    return cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the most frequent longer phrase that holds the phrase."""
    words = phrases.where("size > 2").select("lang", "f", "size", F.split("phrase", " ").alias("words"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.concat_ws(" ", F.slice("words", i, m)))))
    return words.select("lang", "f", F.explode(F.array_distinct(spans)).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, block: int = BLOCK,
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `most` phrases of each language."""
    prepare(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = stage(counted(windows(docs, -(-size // range_bytes) or 1, block), least), "windows")
    sums = stage(rolled_up(found, least), "phrases")
    phrases = sums.where("size > 0")
    kept = scored(phrases).join(covered(phrases), ["lang", "phrase"], "left").where(
        f"longer is null or 100 * longer < {COVERED} * a").drop("longer")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    best = top_n_per_group(kept, "lang", order, "phrase", most)
    totals = sums.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
