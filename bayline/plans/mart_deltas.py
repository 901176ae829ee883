"""The monthly dealer mart under corrections: an order changed, moved to another month, or erased.

A change is told as what an order was and what it is. The mart keeps signed sums: the old state is
taken away, the new one added, each where it belongs. Every load of changes appends its own sums
per month and dealer; a reader adds them up and leaves out keys with no order left. So the mart
always equals one that is built anew, and the cost of a load follows the changes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bayline.functions import month_start
from bayline.operators.commits import Commits
from bayline.operators.registry import LOAD, LoadLog

KEYS = ["month", "dealer_key"]
SUMS = ["ro_count", "total_revenue", "score_sum", "score_count"]
SCHEMA = T.StructType([
    T.StructField("month", T.DateType()),
    T.StructField("dealer_key", T.LongType()),
    T.StructField("ro_count", T.LongType()),
    T.StructField("total_revenue", T.DecimalType(28, 2)),
    T.StructField("score_sum", T.LongType()),
    T.StructField("score_count", T.LongType()),
])


def signed_sums(orders: DataFrame, sign: int) -> DataFrame:
    """What orders add to the mart, or with -1 take from it."""
    score = F.col("satisfaction_score")
    return orders.groupBy(month_start(F.col("service_date")).alias("month"), F.col("dealer_key").cast("long")).agg(
        (sign * F.count("*")).alias("ro_count"), (sign * F.sum("total_amount")).alias("total_revenue"),
        (sign * F.coalesce(F.sum(score), F.lit(0))).cast("long").alias("score_sum"),
        (sign * F.count(score)).alias("score_count"))


def _added(deltas: DataFrame) -> DataFrame:
    """Sums per key. A key that nothing is left of goes, whatever its sums passed through."""
    return deltas.groupBy(*KEYS).agg(*[F.sum(c).cast(SCHEMA[c].dataType).alias(c) for c in SUMS]).where("ro_count <> 0")


def changes(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The orders that differ between two states, as they were and as they are.

    An order is told apart by its number; one that is in both alike is in neither result.
    """
    columns = ["ro_number", "service_date", "dealer_key", "total_amount", "satisfaction_score"]
    both = before.select(*columns, F.lit(-1).alias("_side")).unionByName(after.select(*columns, F.lit(1).alias("_side")))
    left = both.groupBy(*columns).agg(F.sum("_side").alias("_side"))
    return left.where("_side < 0").drop("_side"), left.where("_side > 0").drop("_side")


@dataclass(frozen=True)
class DeltaMart:
    """A mart whose loads are logs of signed sums, each its own folder."""

    path: str

    @property
    def log(self) -> LoadLog:
        return LoadLog(f"{self.path}/deltas", SCHEMA)

    @property
    def compacted(self) -> Commits:
        return Commits(f"{self.path}/compacted")

    def create(self, spark: SparkSession) -> None:
        self.log.create(spark)

    def apply(self, was: DataFrame | None, now: DataFrame | None, load: int) -> None:
        """Take away what orders were and add what they are; None for nothing. May be run again."""
        parts = [signed_sums(df, sign) for df, sign in ((was, -1), (now, 1)) if df is not None]
        if not parts:
            raise ValueError("a load needs changes")
        whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        sums = whole.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        # A move within a key may leave the count as it is, so only rows of zeros are left out.
        self.log.put(sums.where(" or ".join(f"{c} <> 0" for c in SUMS)), load)

    def _deltas(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        rows = self.log.read(spark, None if upto is None else upto + 1)
        if self.compacted.latest(spark) is None:
            return rows
        done = self.compacted.open(spark, "reach").first()[0]
        return self.compacted.open(spark, "mart").unionByName(rows.where(F.col(LOAD) > done).select(*KEYS, *SUMS), True)

    def read(self, spark: SparkSession) -> DataFrame:
        return _added(self._deltas(spark).select(*KEYS, *SUMS))

    def compact(self, spark: SparkSession) -> None:
        """Commit the sums of all loads but the last, which may still be run again."""
        done = self.log.last_load(spark) - 1
        # Sums of keys with no order stay out: were they not all zero, a load would be missing.
        self.compacted.commit({
            "mart": _added(self._deltas(spark, done).select(*KEYS, *SUMS)),
            "reach": spark.range(1).select(F.lit(done).alias(LOAD))})
