"""Chat formatting after cumulative-snapshot collapse.

A log often holds a conversation several times, each time a few turns longer. Every turn gets a
hash of all turns up to it, rolled forward: the exclusive or of the hashes of (position, role,
text), which a running window extends turn by turn. A conversation whose last hash is the hash of an
earlier turn of a longer one is a snapshot of that, and an anti join drops it. Of equal
conversations the smallest id stays. What remains is rendered, in pieces of `PIECE` turns.

Turns are numbered and rolled in blocks of their turn numbers, and the blocks' totals are rolled
after that, so a very long conversation is no single task's work. All of it is DataFrame code;
texts are told apart by two 64-bit hashes.

Defined cases: rows without a conversation id belong to no conversation and are left out; a null
turn number comes before all others, null roles and texts are empty; rows that repeat one another
are one turn; different rows with one turn number follow each other by hash; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bayline.llm.common import prepare, stage

PIECE = 64
# Turn numbers to a block.
BLOCK = 4096
_NO_TURN = -(1 << 40)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, a, b): cleaned rows with two hashes of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_NO_TURN)).alias("turn"),
        role.alias("role"), text.alias("text"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"))


def before(value: Column, window) -> Column:
    """The running value up to the row before."""
    return value.over(window.rowsBetween(Window.unboundedPreceding, -1))


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, a, b, block, at, x, y): each turn's position and its hashes with it."""
    narrow = stage(rows.select("conv_id", "turn", "a", "b").distinct().withColumn(
        "block", F.floor(F.col("turn") / BLOCK)), "turns")
    by_block = Window.partitionBy("conv_id").orderBy("block")
    offsets = narrow.groupBy("conv_id", "block").agg(F.count("*").alias("n")).select(
        "conv_id", "block", F.coalesce(before(F.sum("n"), by_block), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "a", "b")
    placed = narrow.withColumn("row", F.row_number().over(inside)).join(offsets, ["conv_id", "block"])
    at = (F.col("offset") + F.col("row")).alias("at")
    return placed.select("conv_id", "turn", "a", "b", "block", at).select(
        "*", F.xxhash64("at", "a").alias("x"), F.xxhash64("at", "b").alias("y"))


def maximal(placed: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of the conversations that no longer one begins with."""
    def rolled(c: str, window) -> Column:
        return F.coalesce(before(F.bit_xor(c), window), F.lit(0))

    by_block = Window.partitionBy("conv_id").orderBy("block")
    whole = Window.partitionBy("conv_id")
    blocks = stage(placed.groupBy("conv_id", "block").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("at").alias("last")).select(
        "conv_id", "block", rolled("x", by_block).alias("px"), rolled("y", by_block).alias("py"),
        F.bit_xor("x").over(whole).alias("wx"), F.bit_xor("y").over(whole).alias("wy"),
        F.max("last").over(whole).alias("n_turns")), "blocks")
    inside = Window.partitionBy("conv_id", "block").orderBy("at")
    prefixes = placed.select("conv_id", "block", "at", F.bit_xor("x").over(inside).alias("x"),
                             F.bit_xor("y").over(inside).alias("y")).join(blocks, ["conv_id", "block"])
    proper = prefixes.where(F.col("at") < F.col("n_turns")).select(
        F.col("at").alias("n_turns"), F.col("x").bitwiseXOR(F.col("px")).alias("wx"),
        F.col("y").bitwiseXOR(F.col("py")).alias("wy")).distinct()
    ends = blocks.select("conv_id", "n_turns", "wx", "wy").distinct().groupBy("n_turns", "wx", "wy").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    return ends.join(proper, ["n_turns", "wx", "wy"], "left_anti").select("conv_id", "n_turns", "copies")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def formatted(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, n_turns, copies, piece, text) of the maximal conversations, piece by piece."""
    prepare(conversations.sparkSession)
    rows = turns(conversations)
    placed = stage(numbered(rows), "numbered")
    kept = stage(maximal(placed), "maximal")
    wanted = placed.select("conv_id", "turn", "a", "b", "at").join(kept, "conv_id")
    texts = rows.groupBy("conv_id", "turn", "a", "b").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    met = texts.join(wanted, ["conv_id", "turn", "a", "b"]).select(
        "conv_id", "n_turns", "copies", F.floor((F.col("at") - 1) / piece).cast("int").alias("piece"), "at",
        rendered_turn(F.col("role"), F.col("text")).alias("turn_text"))
    return met.groupBy("conv_id", "n_turns", "copies", "piece").agg(
        F.sort_array(F.collect_list(F.struct("at", "turn_text"))).alias("turns")).select(
        "conv_id", "n_turns", "copies", "piece", F.array_join("turns.turn_text", "").alias("text"))
