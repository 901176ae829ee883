"""The warehouse as SQL views, for users who bring their own query texts."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from bayline.plans import marts, retention


def create_views(
    tables: Mapping[str, DataFrame], as_of=None, labelled: DataFrame | None = None,
    events: DataFrame | None = None,
) -> list[str]:
    """Register the tables and the curated views over them; returns the names.

    `labelled` (one row per customer with `retained_next_period`) adds the rate by region, `events`
    the staging view of raw service events.
    """
    fact = tables["fact_repair_orders"]
    views = {
        **tables,
        "v_dealer_performance": marts.dealer_performance_view(fact),
        "mv_monthly_dealer_revenue": marts.monthly_dealer_revenue(fact),
        "v_customer_retention_features": retention.retention_features(
            fact, tables["dim_customer"], tables["dim_vehicle"], as_of),
    }
    if labelled is not None:
        views["v_retention_by_region"] = retention.retention_by_region(
            labelled, tables["dim_dealer"]).orderBy(F.desc("retention_rate_pct"), "region")
    if events is not None:
        views["stg_service_events"] = marts.staging_service_events(events)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def rows(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """The result of a query over the views; the caller decides what to fetch of it."""
    return spark.sql(text, args=dict(args or {}))


def scalar(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> Any:
    """The one value of a one-row query."""
    found = rows(spark, text, args).first()
    return found[0] if found else None
