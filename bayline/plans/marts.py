"""Staging view, curated fact, monthly mart and the views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bayline.functions import money, month_start, parse_date, ratio


def staging_service_events(events: DataFrame) -> DataFrame:
    """Typed service events that have an order number and a non-negative amount."""
    amount = money(F.col("total_amount"))
    return events.select(
        "ro_number",
        F.col("dealer_key").try_cast("int").alias("dealer_key"),
        parse_date(F.col("service_date")).alias("service_date"),
        "service_type",
        amount.alias("total_amount"),
        F.col("satisfaction_score").try_cast("int").alias("satisfaction_score"),
    ).where(F.col("ro_number").isNotNull() & (F.col("total_amount") >= 0))


def curated_fact(raw: DataFrame) -> DataFrame:
    """The curated columns with the month each row belongs to."""
    return raw.select(
        "ro_number", "dealer_key", "service_date",
        month_start(F.col("service_date")).alias("service_month"),
        "service_type", "total_amount", "satisfaction_score",
    )


def monthly_dealer_revenue(fact: DataFrame, rounded: bool = True) -> DataFrame:
    """One row per month and dealer; the average keeps six digits when not rounded for display."""
    return fact.groupBy(F.col("service_month").alias("month"), "dealer_key").agg(
        F.count("*").alias("ro_count"),
        F.sum("total_amount").alias("total_revenue"),
        ratio(F.sum("satisfaction_score"), F.count("satisfaction_score"), 2 if rounded else 6)
        .alias("avg_csat"),
    )


def top_mart_rows(mart: DataFrame, n: int = 3) -> DataFrame:
    return mart.orderBy(F.desc("total_revenue"), "month", "dealer_key").limit(n)


def dealer_performance_view(fact: DataFrame) -> DataFrame:
    """The non-sensitive columns analysts may read."""
    return fact.select(
        "service_date", "dealer_key", "service_type", "pay_type", "total_amount",
        "satisfaction_score",
    )


def pruning_benefit(fact: DataFrame, month, dealer_key: int) -> DataFrame:
    """Rows a one-month, one-dealer query touches without and with the layout; one pass."""
    in_month = F.col("service_month") == F.lit(month).cast("date")
    hit = in_month & (F.col("dealer_key") == dealer_key)
    counted = fact.agg(
        F.count("*").alias("rows_total"),
        F.count_if(in_month).alias("scanned_partition_only"),
        F.count_if(hit).alias("scanned_partition_plus_cluster"),
    )
    saved = F.col("rows_total") - F.col("scanned_partition_plus_cluster")
    return counted.select(
        "rows_total",
        F.col("rows_total").alias("scanned_without_optimization"),
        "scanned_partition_only",
        "scanned_partition_plus_cluster",
        ratio(saved * 100, F.col("rows_total"), 2).alias("cost_reduction_vs_full_scan_pct"),
    )
