"""Erasure that rewrites only the files which hold what is to go.

A table is a set of files named by numbered commits. Beside each file lies a summary of its keys, a
bitmap of the slots of a hash. A request looks its hashes up in the summaries, reads only the files
that may hold one, writes these anew without the rows asked for, and commits a list of files in
which all others keep their names. Every file that was looked at gets a receipt.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bayline.operators.commits import Commits
from bayline.operators.files import Folder
from bayline.session import stage

# Slots of a file's summary, two bitmaps of 32,768 bits for every file.
SLOTS = 1 << 16
_PER_BITMAP = 32_768
FILES = T.StructType([T.StructField("file", T.StringType())])


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS))


@dataclass(frozen=True)
class ErasableTable:
    """A table under `root`, erased by the values of one key column."""

    root: str
    schema: T.StructType
    key: str

    @property
    def commits(self) -> Commits:
        return Commits(f"{self.root}/list")

    def _write(self, rows: DataFrame) -> list[str]:
        """New data files; their names relative to the root."""
        part = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{part}")
        names = Folder(rows.sparkSession, f"{self.root}/{part}").names()
        return [f"{part}/{n}" for n in names if n.endswith(".parquet")]

    def _named(self, spark: SparkSession, files: list[str]) -> DataFrame:
        """Rows of some files with the file's name."""
        if not files:
            return spark.createDataFrame([], self.schema).withColumn("file", F.lit(""))
        rows = spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in files])
        return rows.withColumn("file", F.regexp_extract("_metadata.file_path", r"(data/[^/]+/[^/]+)$", 1))

    def _summaries(self, spark: SparkSession, files: list[str]) -> DataFrame:
        """(file, part, bits): which slots the keys of a file take."""
        slots = self._named(spark, files).select("file", _slot(F.col(self.key)).alias("slot"))
        return slots.groupBy("file", F.floor(F.col("slot") / _PER_BITMAP).alias("part")).agg(
            F.expr(f"bitmap_construct_agg(slot % {_PER_BITMAP})").alias("bits"))

    def _commit(self, spark: SparkSession, files: list[str], summaries: DataFrame, after: int) -> int:
        listed = spark.createDataFrame([(f,) for f in sorted(files)], FILES)
        return self.commits.commit({"files": listed.coalesce(1), "summaries": summaries.coalesce(8)}, after)

    def create(self, rows: DataFrame) -> int:
        spark = rows.sparkSession
        files = self._write(rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]))
        return self._commit(spark, files, self._summaries(spark, files), 0)

    def files(self, spark: SparkSession) -> list[str]:
        # A name for each file; as many as a scan of the table would list.
        return [r.file for r in self.commits.open(spark, "files").collect()]

    def read(self, spark: SparkSession) -> DataFrame:
        return self._named(spark, self.files(spark)).drop("file")

    def suspects(self, spark: SparkSession, requests: DataFrame) -> list[str]:
        """The files whose summaries have a slot of a key that is asked for: all that hold one."""
        asked = requests.select(_slot(F.col(self.key)).alias("slot")).distinct().select(
            F.floor(F.col("slot") / _PER_BITMAP).alias("part"), (F.col("slot") % _PER_BITMAP).alias("at")
        ).groupBy("part").agg(F.expr("bitmap_construct_agg(at)").alias("wanted"))
        both = self.commits.open(spark, "summaries").join(asked, "part").where(_share_a_bit(F.col("bits"), F.col("wanted")))
        return sorted(r.file for r in both.select("file").distinct().collect())

    def erase(self, requests: DataFrame) -> DataFrame:
        """Remove the rows with a key in `requests`; a receipt for each file that was read.

        `erased` and `kept` count the rows of the file; `rewritten` is 0 where it held none of them.
        """
        spark = requests.sparkSession
        after = self.commits.latest(spark)
        listed, suspects = self.files(spark), self.suspects(spark, requests)
        wanted = requests.select(F.col(self.key).alias("_asked"), F.lit(True).alias("_hit")).distinct()
        rows = self._named(spark, suspects)
        marked = stage(rows.join(wanted, rows[self.key] == F.col("_asked"), "left").drop("_asked").withColumn(
            "_hit", F.coalesce("_hit", F.lit(False))), "suspects")
        receipts = stage(marked.groupBy("file").agg(
            F.count_if("_hit").alias("erased"), F.count_if(~F.col("_hit")).alias("kept")).withColumn(
            "rewritten", (F.col("erased") > 0).cast("int")), "receipts")
        gone = [r.file for r in receipts.where("rewritten = 1").collect()]
        if gone:
            left = marked.where(~F.col("_hit") & F.col("file").isin(gone)).drop("_hit", "file")
            new = self._write(left)
            old = self.commits.open(spark, "summaries").where(~F.col("file").isin(gone))
            self._commit(spark, [f for f in listed if f not in gone] + new,
                         old.unionByName(self._summaries(spark, new)), after)
        return receipts

    def sweep(self, spark: SparkSession, older_than: float) -> list[str]:
        """Remove old commits and then the data files that no commit names any more."""
        self.commits.sweep(spark, older_than)
        named = {r.file for n in self.commits.numbers(spark) for r in self.commits.open(spark, "files", n).collect()}
        folder, removed = Folder(spark, self.root), []
        for part in folder.names("data"):
            for name in folder.names(f"data/{part}"):
                file = f"data/{part}/{name}"
                if name.endswith(".parquet") and file not in named and folder.age(file) >= older_than:
                    folder.remove(file)
                    removed.append(file)
        return removed


def _share_a_bit(bits: Column, wanted: Column) -> Column:
    """Have two bitmaps a set bit in common? Compared by words of 60 bits, as hexadecimal text."""
    words = F.sequence(F.lit(0), F.lit(-(-_PER_BITMAP // 4 // 15) - 1))

    def word(text, i):
        return F.conv(F.substring(text, i * 15 + 1, F.lit(15)), 16, 10).cast("long")

    one, other = F.hex(bits), F.hex(wanted)
    return F.exists(words, lambda i: word(one, i).bitwiseAND(word(other, i)) != 0)
