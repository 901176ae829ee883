"""The star schema over the supplied tables, keyed by their natural integer keys.

The tables already carry integer keys, so KPI and mart plans use those and stay one lazy plan
from scan to result; `build_warehouse` is the form with generated keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bayline.functions import email_hash, last4
from bayline.operators import gates
from bayline.plans import warehouse
from bayline.session import prepare
from bayline.sources import service_tables as src


def _natural_keys() -> list[Column]:
    return [
        F.col("dealer_id").cast("bigint").alias("dealer_key"),
        F.col("vin").cast("bigint").alias("vehicle_key"),
        F.col("customer_id").alias("customer_key"),
    ]


@dataclass(frozen=True)
class Star:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def raw_orders(self) -> DataFrame:
        return src.raw_orders(self.spark, self.sf_dir, near=True)

    @cached_property
    def clean(self) -> DataFrame:
        return gates.clean_orders(self.raw_orders.drop(gates.NEAR))

    @cached_property
    def fact(self) -> DataFrame:
        base = self.clean.select("ro_number", *_natural_keys(), *warehouse.measures())
        return warehouse.with_survey(base, src.surveys(self.spark, self.sf_dir))

    @cached_property
    def settled_fact(self) -> DataFrame:
        """The rows of `fact` for storing: gates and surveys come to where the orders lie, which are not shuffled again."""
        base = gates.clean_orders(self.raw_orders).select(gates.NEAR, "ro_number", *_natural_keys(), *warehouse.measures())
        return warehouse.with_survey(base, src.surveys(self.spark, self.sf_dir, near=True)).drop(gates.NEAR)

    @cached_property
    def dim_dealer(self) -> DataFrame:
        return src.dealers(self.spark, self.sf_dir).select(
            F.col("arrival").alias("dealer_key"), "dealer_id", "dealer_name", "region",
            "service_bays", "nation_key",
        )

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return src.vehicles(self.spark, self.sf_dir).select(
            F.col("arrival").alias("vehicle_key"), "vin", "model", "model_year",
            "warranty_months", "in_service_date",
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        return src.customers(self.spark, self.sf_dir).select(
            "customer_key",
            email_hash(F.col("customer_email")).alias("email_hash"),
            last4(F.col("customer_phone")).alias("phone_last4"),
            "consent_status", "nation_key",
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return warehouse.dim_date(self.clean)

    def sources(self) -> warehouse.Sources:
        return warehouse.Sources(
            orders=src.raw_orders(self.spark, self.sf_dir, contacts=True, near=True),
            vehicles=src.vehicles(self.spark, self.sf_dir),
            dealers=src.dealers(self.spark, self.sf_dir),
            surveys=src.surveys(self.spark, self.sf_dir),
        )


def star(spark: SparkSession, sf_dir: str) -> Star:
    # Rows that lie together by a part of a join's keys (`gates.NEAR`) stay where they are.
    prepare(spark).conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return Star(spark, sf_dir)
