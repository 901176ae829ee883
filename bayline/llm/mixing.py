"""Temperature mixing of sources.

A source's natural share p is its part of all tokens (words). Its weight is p ** t, normalised. The
exponent t, from 1 (natural) to 0 (equal), is found by section: the largest one whose entropy
reaches a target, or whose largest repetition is the limit or less. The budget is either given or
the smallest in which every document comes at least once.

Weights times budget give each source its tokens. They are realised as block permutations: a
source's documents come whole in as many shuffled blocks as fit, then a last block brings the first
documents of one more permutation, as long as their tokens fit into what is left. `place` orders
the copies so that any beginning of the sequence has about the target weights.

All of it is DataFrame code. The cut of the last block is found from token sums by hash bucket, two
levels of 4,096, so no task ever sorts a source.

Defined cases: a null source is the empty name; null and empty texts have 0 tokens and take part
in every whole block; a source without tokens comes once; with one source, or equal ones, any
exponent gives the natural mix; documents with the same id (or none) and source share their places and
are taken or left together in a last block; repeated rows are mixed as rows; extra columns are kept
by `mixed`; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from bayline.llm.common import prepare, stage

MAX_REPEATS = 2.0
SEED = "mix"
# The exponent is found in steps of a millionth.
_STEPS = 1_000_000
_KEY_BITS, _BUCKET_BITS = 60, 12


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_name(docs: DataFrame) -> Column:
    return F.coalesce(docs["source"].cast("string"), F.lit(""))


def permutation_key(doc_id: Column, epoch: Column) -> Column:
    """Place of a document in the permutation of an epoch, 60 bits."""
    named = F.concat_ws(":", F.lit(SEED), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def exponent(totals: DataFrame, target_entropy: float | None, max_repeats: float | None,
             budget: int | None = None) -> float:
    """The largest exponent in [0, 1] that reaches the entropy, a share of that of equal weights;
    or the smallest that keeps the repetition limit. Each pass cuts the range sixteenfold."""
    known = totals.where("tokens > 0")
    everything, sources = known.agg(F.sum("tokens"), F.count("*")).first()
    share = F.col("tokens") / F.lit(float(everything or 1))
    power = F.pow(share, F.col("t"))
    # Copies of a source per natural copy, up to the norm of the weights.
    copies = F.pow(share, F.col("t") - 1)
    low, high = 0, _STEPS
    while low < high:
        grid = sorted({low + (high - low) * i // 16 for i in range(17)})
        at = known.withColumn("step", F.explode(F.array(*map(F.lit, grid)))).withColumn(
            "t", F.col("step") / _STEPS)
        norm = F.sum(power)
        repeats = F.max(copies) / F.min(copies) if budget is None else F.max(copies) / norm * budget / everything
        fits = (repeats <= max_repeats + 1e-9) if target_entropy is None else (
            F.log(norm) - F.sum(power * F.log(power)) / norm >= target_entropy * math.log(sources or 1) - 1e-9)
        good = {r["step"] for r in at.groupBy("step").agg(fits.alias("fits")).where("fits").collect()}
        if target_entropy is None:
            # Larger exponents repeat less.
            least = min(good, default=_STEPS)
            low, high = max([s for s in grid if s < least], default=least), least
            low = low + 1 if high - low == 1 else low
        else:
            most = max(good, default=0)
            low, high = most, min([s for s in grid if s > most], default=most)
            high = low if high - low == 1 else high
    return low / _STEPS


def plan(rows: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
         budget: int | None = None) -> DataFrame:
    """(source, tokens, repeats, whole, rest): copies of each source, whole blocks, tokens beyond.

    `rows` has (doc_id, source, n_tokens). Without any goal the repetition limit is `MAX_REPEATS`.
    """
    if target_entropy is not None and max_repeats is not None:
        raise ValueError("state either target_entropy or max_repeats")
    if target_entropy is None and max_repeats is None:
        max_repeats = MAX_REPEATS
    totals = stage(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    t = exponent(totals, target_entropy, max_repeats, budget)
    most, norm = totals.where("tokens > 0").agg(
        F.max("tokens"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(t)))).first()
    ratio = F.pow(F.lit(most) / F.col("tokens"), F.lit(1 - t)) if budget is None else (
        F.pow(F.col("tokens").cast("double"), F.lit(t)) / F.lit(norm) * budget / F.col("tokens"))
    repeats = F.when(F.col("tokens") > 0, ratio).otherwise(1.0)
    return totals.select("source", "tokens", repeats.alias("repeats")).select(
        "*", F.floor("repeats").cast("int").alias("whole")).select(
        "*", F.floor((F.col("repeats") - F.col("whole")) * F.col("tokens")).cast("long").alias("rest"))


def with_cut(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The plan with `cut`: the largest key that the last block of the source takes, or -1."""
    key = permutation_key(F.col("doc_id"), F.col("whole"))
    left = rows.join(planned.where("rest > 0").select("source", "whole", "rest"), "source").select(
        "source", key.alias("key"), "n_tokens", "rest")
    for level in (1, 2):
        shift = _KEY_BITS - level * _BUCKET_BITS
        bucket = F.shiftright("key", shift)
        sums = left.withColumn("bucket", bucket).groupBy("source", "bucket").agg(
            F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        # The first bucket that doesn't fit, and what is left for it.
        torn = sums.withColumn("upto", upto).where("upto > rest").groupBy("source").agg(
            F.min_by(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("n")).alias("rest")), "bucket").alias("b")
        ).select("source", F.col("b.bucket").alias("bucket"), F.col("b.rest").alias("rest"))
        left = left.drop("rest").withColumn("bucket", bucket).join(torn, ["source", "bucket"]).drop("bucket")
    by_key = left.groupBy("source", "key").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("key"))
    # The first key left out; if every key fits, the rest of the block is empty.
    cut = by_key.withColumn("upto", upto).where("upto > rest").groupBy("source").agg(F.min("key").alias("beyond"))
    everything = F.when(F.col("rest") > 0, F.lit(1 << _KEY_BITS)).otherwise(F.lit(0))
    return planned.join(cut, "source", "left").select(
        "source", "repeats", "whole", (F.coalesce("beyond", everything) - 1).alias("cut"))


def free_name(docs: DataFrame, name: str) -> str:
    """The name, lengthened until no column of `docs` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mixed(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
          budget: int | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """All columns of `docs`, a row per copy. `more` names columns to add: epoch, place, n_tokens."""
    prepare(docs.sparkSession)
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_name(docs).alias("source"),
                             token_count(F.col("text")).alias("n_tokens")), "sized")
    cuts = stage(with_cut(rows, plan(rows, target_entropy, max_repeats, budget)), "cuts")
    m, e = free_name(docs, "_mix"), free_name(docs, "_epoch")
    by = cuts.select(F.struct("*").alias(m))
    copies = docs.join(by, source_name(docs) == F.col(f"{m}.source")).withColumn(
        e, F.explode(F.sequence(F.lit(0), F.col(f"{m}.whole"))))
    key = permutation_key(docs["doc_id"].cast("long"), F.col(e))
    # Without a last block the cut is -1, below every key.
    taken = copies.where((F.col(e) < F.col(f"{m}.whole")) | (key <= F.col(f"{m}.cut")))
    made = {
        "epoch": F.col(e),
        "place": F.round((F.col(e) + key / F.lit(float(1 << _KEY_BITS))) / F.col(f"{m}.repeats"), 6),
        "n_tokens": token_count(docs["text"]),
    }
    return taken.select(*[docs[f"`{c}`"] for c in docs.columns],
                        *[made[what].alias(name) for what, name in (more or {}).items()])


def mixture(docs: DataFrame, **goal) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, place) of every copy."""
    found = mixed(docs.select("doc_id", "text", "source"), **goal,
                  more={"n_tokens": "n_tokens", "epoch": "epoch", "place": "place"})
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"),
                        "n_tokens", "epoch", "place")
