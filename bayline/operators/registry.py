"""Tables that grow load by load, and surrogate keys that outlive a load.

A load log keeps each load's rows in a folder of its own. A load that is run again replaces its own
folder and reads only the folders before it, so a replay after a crash changes nothing; a load that
others have built upon can't be replaced. A key registry is such a log of natural keys, each with
the number that the load which first brought it gave it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bayline.operators.files import Folder
from bayline.operators.ranking import with_surrogate_key
from bayline.session import COMPACT

LOAD = "load"


@dataclass(frozen=True)
class LoadLog:
    """Rows of a fixed schema under `path`, a folder for each load."""

    path: str
    schema: T.StructType

    def create(self, spark: SparkSession) -> None:
        spark.createDataFrame([], self.schema).write.parquet(f"{self.path}/{LOAD}=0")

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All rows with their load, or those of the loads before one; skips the other folders."""
        stored = T.StructType([*self.schema.fields, T.StructField(LOAD, T.IntegerType())])
        rows = spark.read.schema(stored).parquet(self.path)
        return rows if before is None else rows.where(F.col(LOAD) < before)

    def last_load(self, spark: SparkSession) -> int:
        # A load without rows is a folder too, which a query over rows would not see.
        names = Folder(spark, self.path).names()
        return max(int(n.partition("=")[2]) for n in names if n.startswith(f"{LOAD}="))

    def put(self, rows: DataFrame, load: int) -> None:
        spark = rows.sparkSession
        last = self.last_load(spark)
        if load < 1 or load < last:
            raise ValueError(f"load {load} of {self.path} can't be written after load {last}")
        if load > last + 1:
            raise ValueError(f"load {last + 1} of {self.path} is missing before load {load}")
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.mode(
            "overwrite").parquet(f"{self.path}/{LOAD}={load}", compression=COMPACT)


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equal in all columns, NULL equal to NULL."""
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


@dataclass(frozen=True)
class KeyRegistry:
    """Numbers natural keys for good: an old key keeps its number, new ones go on from the largest.

    Within a load, keys are numbered in the order in which they first arrive, without gaps.
    """

    log: LoadLog
    natural: tuple[str, ...]
    key: str

    @staticmethod
    def at(path: str, natural: T.StructType, key: str) -> KeyRegistry:
        schema = T.StructType([*natural.fields, T.StructField(key, T.LongType())])
        return KeyRegistry(LoadLog(path, schema), tuple(natural.fieldNames()), key)

    def create(self, spark: SparkSession) -> None:
        self.log.create(spark)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.log.read(spark)

    def extend(self, rows: DataFrame, order: str, load: int) -> None:
        """Number the keys in `rows` that no load before has. `order` is unique per row.

        Only the distinct keys of the new rows are joined and only unseen ones are sorted.
        """
        spark = rows.sparkSession
        known = self.log.read(spark, before=load)
        arriving = rows.groupBy(*self.natural).agg(F.min(order).alias("_first"))
        unseen = arriving.join(known, same(arriving, known, self.natural), "left_anti")
        start = known.agg(F.coalesce(F.max(self.key), F.lit(0))).scalar()
        numbered = with_surrogate_key(unseen, [F.col("_first")], self.key, keep=self.natural)
        self.log.put(numbered.withColumn(self.key, F.col(self.key) + start), load)

    def resolve(self, rows: DataFrame) -> DataFrame:
        """Add the keys; NULL for a natural key that no load had. Keys never multiply rows."""
        known = self.read(rows.sparkSession).select(*self.natural, self.key)
        return rows.join(known, same(rows, known, self.natural), "left").select(*[rows[c] for c in rows.columns], self.key)
