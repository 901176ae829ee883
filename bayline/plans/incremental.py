"""The warehouse load by load: gates that know earlier loads, keys that last, facts that are added.

`IncrementalWarehouse.load` takes what one delivery brought. Its cost follows the delivery: the
state that earlier loads left is joined to it, never gated or numbered again. Running a load again
replaces what that load wrote. The result of n loads is that of one load over all rows in order of
(load, arrival), with two differences: keys are numbered load by load, and an order whose dealer or
vehicle comes with a later load stays quarantined as an orphan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bayline import schemas
from bayline.operators import gates
from bayline.operators.registry import LOAD, KeyRegistry, LoadLog
from bayline.plans import warehouse
from bayline.session import COMPACT, stage

_TEXT = T.StringType()


def _schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TEXT) for n in names])


@dataclass(frozen=True)
class IncrementalWarehouse:
    root: str

    @property
    def registries(self) -> dict[str, KeyRegistry]:
        return {
            name: KeyRegistry.at(f"{self.root}/keys/{name}", _schema(natural), f"{name}_key")
            for name, natural in (("dealer", "dealer_id"), ("vehicle", "vin"), ("customer", "email_hash"))
        }

    @property
    def accepted(self) -> LoadLog:
        """The gate's state: order numbers with a clean arrival."""
        return LoadLog(f"{self.root}/gate", _schema(gates.KEY))

    @property
    def rejects(self) -> LoadLog:
        return LoadLog(f"{self.root}/rejects", _schema(gates.KEY, gates.REASON, "raw_row"))

    @property
    def facts(self) -> LoadLog:
        return LoadLog(f"{self.root}/facts", schemas.FACT)

    def _logs(self) -> Sequence[LoadLog]:
        return [*(r.log for r in self.registries.values()), self.accepted, self.rejects, self.facts]

    def create(self, spark: SparkSession) -> None:
        for log in self._logs():
            log.create(spark)

    def load(self, sources: warehouse.Sources, load: int) -> None:
        spark = sources.orders.sparkSession
        seen = self.accepted.read(spark, before=load).select(gates.KEY)
        gated = stage(gates.protect_contacts(gates.gate_orders(sources.orders, seen=seen)), "gated", COMPACT)
        clean = gates.passed(gated)
        keys = self.registries
        for name, rows in (("dealer", sources.dealers), ("vehicle", sources.vehicles), ("customer", clean)):
            keys[name].extend(rows, gates.ARRIVAL, load)

        dealers, vehicles, customers = (keys[n].read(spark) for n in ("dealer", "vehicle", "customer"))
        orphans = stage(warehouse.orphan_rejects(clean, dealers, vehicles), "orphans")
        conformed = warehouse.conform_fact(clean, dealers, vehicles, customers, sources.surveys)
        start = self.facts.read(spark, before=load).agg(F.coalesce(F.max("ro_key"), F.lit(0))).scalar()
        numbers = warehouse.order_keys(clean, orphans)
        self.facts.put(warehouse.keyed_fact(conformed, numbers.withColumn("ro_key", F.col("ro_key") + start)), load)
        self.rejects.put(gates.quarantine(gated).unionByName(orphans), load)
        # The state last: what reads it as finished finds all tables of the load.
        self.accepted.put(clean.select(F.coalesce(F.col(gates.KEY), F.lit("")).alias(gates.KEY)), load)

    def fact(self, spark: SparkSession) -> DataFrame:
        return self.facts.read(spark)

    def keys(self, spark: SparkSession) -> DataFrame:
        """(dimension, natural_key, surrogate_key, load) of all registries."""
        parts = [
            r.read(spark).select(F.lit(name).alias("dimension"), F.col(r.natural[0]).alias("natural_key"),
                                 F.col(r.key).alias("surrogate_key"), LOAD)
            for name, r in self.registries.items()]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
