"""How far the vocabulary of each source lies from that of other sources of its language.

Each partition folds its documents into stripes: a hash table from a term to the number of
documents that hold it and its count in each source, kept in arrays. A table that grows beyond
`CELLS` counts is spilled as rows and begun anew. Spark deals the rows by (lang, term) and sorts them, and one pass
over each sorted partition merges the stripes of a term, one stripe in memory at a time. Merged
stripes of terms in at least `LEAST` documents give the totals, then go, in shards of about `SHARD`
terms, to tasks that turn them into smoothed shares and emit the divergences: sums over all terms
for every pair of sources, and for each source the terms that it uses more than its language does.
Sources of a language are dealt into blocks of about `BLOCK`, and a task handles one pair of
blocks, so its memory doesn't grow with the number of sources; where there is more than one block,
terms that neither block has are added in closed form.

All arithmetic is in whole numbers: shares are 1 + floor(10**9 * (count + 1) / (N + V)) and a
divergence is floor((p - q)**2 / q). Exact while the counts of a language sum to less than 9 * 10**15.

Defined cases: null text, lang and source are empty strings; every row is a document of its own,
so repeated rows count again; a text without terms still makes its (lang, source) occur; a language
without kept terms has pairs of value 0 and no terms; ties go to the smaller item by its UTF-8
bytes; a long text is read in slices; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from bayline.llm.common import prepare, stage
from bayline.operators.ranking import top_n_per_group

LEAST = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
CELLS = 800_000
SHARD = 4096
BLOCK = 128
_SLICE = 1 << 20
# Above these bits of a key lies the number of a group, a language or a document.
_TERM_BITS = 40
_NONE = np.zeros(0, np.int64)
# Rows without texts are short; batches stay bounded by their bytes.
_ARROW_ROWS = 8192
# ASCII letters, and the bytes of any other character.
_TERMS = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")

STRIPES = "lang string, term string, df long, sources array<string>, counts array<long>"
EMITTED = "lang string, source string, part string, item string, value long, seen long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice after slice; no term is cut."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + _SLICE) if len(text) - at > _SLICE else None
        stop = cut.start() if cut else len(text)
        yield _TERMS.findall((text if stop - at == len(text) else text[at:stop]).lower())
        at = stop


class Numbers(dict):
    """Numbers what it is asked for in the order in which it comes."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    distinct, place = np.unique(np.concatenate([_NONE, *keys]), return_inverse=True)
    # Sums stay exact: a task counts far less than 2**53 terms.
    return distinct, np.bincount(place, np.concatenate([_NONE, *counts]), len(distinct)).astype(np.int64)


class Stripes:
    """A hash table from terms to stripes, whose counts lie in arrays by (group, term).

    `term` numbers the terms, `group` the (lang, source) pairs and `lang` the languages.
    """

    def __init__(self):
        self.term, self.group, self.lang = Numbers(), Numbers(), Numbers()
        self.cells: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)
        self.df: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)

    def __len__(self) -> int:
        return len(self.cells[0])

    def fold(self, langs: list[str], sources: list[str], texts: list[bytes]) -> None:
        """Add whole documents: each one's terms are counted, then added to their stripes."""
        groups, of_lang, codes, sizes = [], [], [], []
        for lang, source, text in zip(langs, sources, texts):
            groups.append(self.group[lang, source])
            of_lang.append(self.lang[lang])
            size = 0
            for some in terms(text):
                codes.append(np.fromiter(map(self.term.__getitem__, some), np.int64, len(some)))
                size += len(some)
            sizes.append(size)
        owner = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
        held, n = np.unique(owner << _TERM_BITS | np.concatenate([_NONE, *codes]), return_counts=True)
        owner, term = held >> _TERM_BITS, held & ((1 << _TERM_BITS) - 1)
        cells = np.array(groups, np.int64)[owner] << _TERM_BITS | term
        documents = np.array(of_lang, np.int64)[owner] << _TERM_BITS | term
        self.cells = summed([self.cells[0], cells], [self.cells[1], n])
        self.df = summed([self.df[0], documents], [self.df[1], np.ones_like(n)])

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All stripes as rows."""
        keys, counts = self.cells
        mask = (1 << _TERM_BITS) - 1
        pairs = list(self.group)
        lang = np.array([self.lang[lang] for lang, _ in pairs], np.int64)[keys >> _TERM_BITS]
        stripe = lang << _TERM_BITS | keys & mask
        order = np.argsort(stripe, kind="stable")
        # The documents' table has the same (lang, term) keys, in order.
        starts = np.append(np.searchsorted(stripe[order], self.df[0]), len(keys))
        sources = pa.array([s for _, s in pairs], pa.string()).take(pa.array(keys[order] >> _TERM_BITS))
        counts = pa.array(counts[order])
        names = pa.array(list(self.term), pa.binary()).cast(pa.string())
        langs = pa.array(list(self.lang), pa.string())
        for i in range(0, len(self.df[0]), 8192):
            some = self.df[0][i:i + 8192]
            at = starts[i:i + 8193]
            offsets = pa.array((at - at[0]).astype(np.int32))
            span = int(at[0]), int(at[-1] - at[0])
            yield pa.RecordBatch.from_arrays([
                langs.take(pa.array(some >> _TERM_BITS)), names.take(pa.array(some & mask)),
                pa.array(self.df[1][i:i + 8192]),
                pa.ListArray.from_arrays(offsets, sources.slice(*span)),
                pa.ListArray.from_arrays(offsets, counts.slice(*span)),
            ], ["lang", "term", "df", "sources", "counts"])


def folded(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Stripes of each partition, spilled whenever they hold `cells` counts."""
    def fold(batches: Iterator[pa.RecordBatch]):
        stripes = Stripes()
        for batch in batches:
            stripes.fold(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")))
            if len(stripes) >= cells:
                yield from stripes.rows()
                stripes = Stripes()
        yield from stripes.rows()

    return docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(fold, STRIPES)


def same_key(batch: pa.RecordBatch) -> np.ndarray:
    """For each row the number of its stripe; rows of one (lang, term) lie together."""
    new = np.zeros(batch.num_rows, bool)
    for name in ("lang", "term"):
        column = batch.column(name)
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.cumsum(new)


def merged_stripes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row for each (lang, term) of sorted rows."""
    stripe = same_key(batch)
    firsts = np.flatnonzero(np.diff(stripe, prepend=-1))
    if len(firsts) == batch.num_rows:
        return batch
    lists = batch.column("sources")
    sources = lists.flatten().dictionary_encode()
    n = len(sources.dictionary) or 1
    owner = np.repeat(stripe, lists.value_lengths().to_numpy())
    keys, counts = summed([owner * n + sources.indices.to_numpy().astype(np.int64)],
                          [batch.column("counts").flatten().to_numpy()])
    offsets = pa.array(np.searchsorted(keys, np.arange(len(firsts) + 1) * n).astype(np.int32))
    at = pa.array(firsts)
    return pa.RecordBatch.from_arrays([
        batch.column("lang").take(at), batch.column("term").take(at),
        pa.array(np.add.reduceat(batch.column("df").to_numpy(), firsts)),
        pa.ListArray.from_arrays(offsets, sources.dictionary.take(pa.array(keys % n))),
        pa.ListArray.from_arrays(offsets, pa.array(counts)),
    ], batch.schema.names)


def merged(stripes: DataFrame, least: int = LEAST) -> DataFrame:
    """One stripe per (lang, term) found in at least `least` documents, with `n`, its whole count."""
    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(pc.greater_equal(batch.column("df"), least))
        counts = batch.column("counts")
        sums = np.add.reduceat(np.append(counts.flatten().to_numpy(), 0), counts.offsets.to_numpy()[:-1] - counts.offsets[0].as_py())
        return pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("term"), pa.array(sums[:batch.num_rows], pa.int64()),
             batch.column("sources"), counts], ["lang", "term", "n", "sources", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]):
        last = None
        for batch in batches:
            # Columns come from Spark in their own order; the last stripe may go on in the next batch.
            batch = batch.select(["lang", "term", "df", "sources", "counts"])
            if last is not None:
                batch = pa.Table.from_batches([last, batch.cast(last.schema)]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            batch = merged_stripes(batch)
            last = batch.slice(batch.num_rows - 1)
            if batch.num_rows > 1:
                yield kept(batch.slice(0, batch.num_rows - 1))
        if last is not None:
            yield kept(last)

    return stripes.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(
        merge, "lang string, term string, n long, sources array<string>, counts array<long>")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), a thousandfold at a time so that nothing overflows."""
    whole, rest = np.divmod(counts + 1, totals)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + more
    return whole + 1


def groups(docs: DataFrame, kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every (lang, source) that occurs: its total of kept terms and its language's figures."""
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    totals = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy(
        "lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("total"))
    occurring = docs.select("lang", "source").distinct()
    sizes = occurring.groupBy("lang").agg(F.ceil(F.count("*") / block).alias("blocks"))
    return (occurring.join(totals, ["lang", "source"], "left").join(sizes, "lang").join(langs, "lang", "left")
            .na.fill(0, ["total", "v", "lang_total"])
            .withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))))


def _paired(rows: DataFrame) -> DataFrame:
    """A copy of each row for every pair of blocks that its own block is in."""
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    pairs = F.array_distinct(F.concat(
        F.transform(others, lambda i: F.struct(F.col("block").alias("a"), i.alias("b"))),
        F.transform(others, lambda i: F.struct(i.alias("a"), F.col("block").alias("b")))))
    return rows.withColumn("pair", F.explode(pairs)).select("*", "pair.a", "pair.b").drop("pair")


def emitted(kept: DataFrame, grouped: DataFrame, top: int = TOP_TERMS, shard: int = SHARD) -> DataFrame:
    """Part sums of pairs, with the number of terms in them, and each shard's foremost terms."""
    shards = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / shard))
    langs = grouped.select("lang", "blocks", shards.alias("shards")).distinct()
    blocks = F.array_distinct(F.transform("sources", lambda s: F.pmod(F.xxhash64(s), F.col("blocks"))))
    split = (
        kept.join(langs, "lang")
        .withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")))
        .withColumn("block", F.explode(blocks))
        .withColumn("cells", F.filter(F.arrays_zip("sources", "counts"), lambda c: F.pmod(
            F.xxhash64(c["sources"]), F.col("blocks")) == F.col("block"))))
    stripes = _paired(split).select(
        "lang", "a", "b", "shard", "block", "term", "n", F.col("cells.sources").alias("sources"),
        F.col("cells.counts").alias("counts"))
    members = _paired(
        grouped.where("v > 0").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)))
    ).select("lang", "a", "b", "shard", "block", "source", "total", "v", "lang_total")
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()),
                        ("item", pa.string()), ("value", pa.int64()), ("seen", pa.int64())])

    def emit(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        lang, a, b = (left.column(c)[0].as_py() for c in ("lang", "a", "b"))
        info = sorted(zip(*(right.column(c).to_pylist() for c in ("block", "source", "total"))))
        v, lang_total = (right.column(c)[0].as_py() for c in ("v", "lang_total"))
        place = {source: i for i, (_, source, _) in enumerate(info)}
        of_block = {x: np.array([i for i, g in enumerate(info) if g[0] == x], np.int64) for x in {a, b}}
        whole = dict(zip(left.column("term").to_pylist(), left.column("n").to_pylist()))
        row = {term: i for i, term in enumerate(sorted(whole))}
        counts = np.zeros((len(row), len(info)), np.int64)
        for term, sources, some in zip(*(left.column(c).to_pylist() for c in ("term", "sources", "counts"))):
            counts[row[term], [place[s] for s in sources]] = some
        p = shares(counts, np.array([t for _, _, t in info], np.int64) + v)
        names, items = list(place), list(row)
        out = []
        right_p = p[:, of_block[b]]
        for i in of_block[a].tolist():
            sums = ((p[:, i:i + 1] - right_p) ** 2 // right_p).sum(axis=0).tolist()
            out += [(lang, names[i], "pair", names[j], value, len(items))
                    for j, value in zip(of_block[b].tolist(), sums) if i != j]
        if a == b:
            q = shares(np.array([whole[t] for t in items], np.int64), np.int64(lang_total + v))
            for i in of_block[a].tolist():
                more = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
                value = (p[more, i] - q[more]) ** 2 // q[more]
                # Rows are in the order of the terms, so a stable sort breaks ties by them.
                best = np.argsort(-value, kind="stable")[:top]
                out += [(lang, names[i], "term", items[more[k]], int(value[k]), 1) for k in best.tolist()]
        if not out:
            return schema.empty_table()
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    keys = ["lang", "a", "b", "shard"]
    return stripes.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(emit, EMITTED)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP_TERMS, cells: int = CELLS,
          shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources, and each source's foremost terms."""
    prepare(docs.sparkSession).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_ARROW_ROWS))
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = stage(merged(folded(docs, cells), least), "stripes")
    grouped = stage(groups(docs, kept, block), "groups")
    found = stage(emitted(kept, grouped, top, shard), "divergences")
    prepare(docs.sparkSession)

    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    others = grouped.select("lang", F.col("source").alias("item"), F.col("total").alias("other_total"))
    pairs = grouped.join(others, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    # Terms that neither source's block has: as many times the divergence of two counts of 0.
    unseen = "(v - coalesce(seen, 0)) * (((p - q) * (p - q)) div q)"
    pairs = (pairs.withColumn("p", F.expr(f"if(v > 0, 1 + {SCALE} div (total + v), 1)"))
             .withColumn("q", F.expr(f"if(v > 0, 1 + {SCALE} div (other_total + v), 1)"))
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.expr(f"coalesce(value, 0) + {unseen}").alias("value")))
    terms = found.where("part = 'term'").select(
        "lang", "source", "part", "item", "value", F.struct("lang", "source").alias("group"))
    foremost = top_n_per_group(terms, "group", [F.desc("value"), F.col("item")], "item", top).drop("group")
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return pairs.unionByName(foremost).withColumn("rank", F.row_number().over(by_value))
