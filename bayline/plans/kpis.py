"""KPI library over the star schema.

Facts are aggregated on their foreign key before a dimension is joined. The join then moves one
row per key instead of one row per order, and a key that owns many orders is combined inside the
map tasks. Row order is left to `ordered`, except where a limit needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bayline.functions import ratio, share_pct


def fixed_first_visit(fact: DataFrame, dealers: DataFrame) -> DataFrame:
    """Share of orders that were no repeat repair, by region."""
    per_dealer = fact.groupBy("dealer_key").agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("repeat_repair_flag") == 0).alias("fixed"),
    )
    return (
        per_dealer.join(dealers, "dealer_key")
        .groupBy("region")
        .agg(
            share_pct(F.sum("fixed"), F.sum("orders")).alias("fixed_first_visit_pct"),
            F.sum("orders").alias("repair_orders"),
        )
        .orderBy(F.desc("fixed_first_visit_pct"), "region")
    )


def dealer_csat_top(fact: DataFrame, dealers: DataFrame, n: int = 10, least: int = 50):
    """Best dealers by satisfaction. Counts and revenue cover surveyed orders only."""
    surveyed = fact.where(F.col("satisfaction_score").isNotNull())
    per_dealer = (
        surveyed.groupBy("dealer_key")
        .agg(
            ratio(F.sum("satisfaction_score"), F.count("*"), 2).alias("avg_csat"),
            ratio(F.sum("total_amount"), F.count("*"), 2).alias("avg_revenue_per_ro"),
            F.count("*").alias("ro_count"),
        )
        .where(F.col("ro_count") >= least)
    )
    return (
        per_dealer.join(dealers, "dealer_key")
        .select("dealer_name", "region", "avg_csat", "avg_revenue_per_ro", "ro_count")
        .orderBy(F.desc("avg_csat"), F.desc("avg_revenue_per_ro"), "dealer_name")
        .limit(n)
    )


def pay_mix_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    per_day = fact.groupBy("open_date_key").agg(*[
        F.sum(F.when(F.col("pay_type") == pay, F.col("total_amount")).otherwise(0)).alias(pay)
        for pay in ("warranty", "customer")
    ])
    return (
        per_day.join(dates, F.col("open_date_key") == F.col("date_key"))
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("warranty").alias("warranty_spend"),
            F.sum("customer").alias("customer_pay_revenue"),
        )
        .orderBy("year", "month")
    )


def throughput_per_bay(fact: DataFrame, dealers: DataFrame, n: int = 10) -> DataFrame:
    per_dealer = fact.groupBy("dealer_key").agg(F.count("*").alias("annual_ros"))
    return (
        per_dealer.join(dealers, "dealer_key")
        .select(
            "dealer_name", "service_bays", "annual_ros",
            ratio(F.col("annual_ros"), F.col("service_bays"), 1).alias("ros_per_bay"),
        )
        .orderBy(F.desc("ros_per_bay"), "dealer_name")
        .limit(n)
    )


def csat_by_cycle_time(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("satisfaction_score").isNotNull())
        .groupBy("days_to_close")
        .agg(
            ratio(F.sum("satisfaction_score"), F.count("*"), 2).alias("avg_csat"),
            F.count("*").alias("surveyed_ros"),
        )
        .orderBy("days_to_close")
    )


def recall_share(fact: DataFrame, vehicles: DataFrame) -> DataFrame:
    per_vehicle = fact.groupBy("vehicle_key").agg(
        F.count_if(F.col("service_type") == "recall").alias("recalls"),
        F.count("*").alias("orders"),
    )
    return (
        per_vehicle.join(vehicles, "vehicle_key")
        .groupBy("model")
        .agg(
            F.sum("recalls").alias("recall_ros"),
            F.sum("orders").alias("total_ros"),
            share_pct(F.sum("recalls"), F.sum("orders")).alias("recall_share_pct"),
        )
        .orderBy(F.desc("recall_share_pct"), "model")
    )


def headline(fact: DataFrame) -> DataFrame:
    """Order count, fixed-first-visit share, satisfaction, customer-pay revenue in millions."""
    customer_pay = F.sum(F.when(F.col("pay_type") == "customer", F.col("total_amount")))
    return fact.agg(
        F.count("*").alias("repair_orders"),
        share_pct(F.count_if(F.col("repeat_repair_flag") == 0), F.count("*"))
        .alias("fixed_first_visit_pct"),
        ratio(F.sum("satisfaction_score"), F.count("satisfaction_score"), 2).alias("avg_csat"),
        ratio(customer_pay, F.lit(1_000_000), 1).alias("customer_pay_revenue_m"),
    )


def _tile(df: DataFrame, tile: str, label, series: str, value: str, digits: int, order) -> DataFrame:
    # `ord` numbers the handful of aggregated chart points of one tile.
    place = F.row_number().over(Window.partitionBy("tile").orderBy(*order))
    return df.withColumn("tile", F.lit(tile)).select(
        "tile", place.cast("bigint").alias("ord"), label.alias("label"),
        F.lit(series).alias("series"), F.col(value).cast("double").alias("value"),
        F.format_number(F.col(value), digits).alias("display"),
    )


def dashboard_tiles(
    fact: DataFrame, dealers: DataFrame, vehicles: DataFrame, dates: DataFrame
) -> DataFrame:
    """All chart points of the dashboard in long form: tile, ord, label, series, value, display."""
    ffv, recall = fixed_first_visit(fact, dealers), recall_share(fact, vehicles)
    cycle = csat_by_cycle_time(fact)
    mix = pay_mix_by_month(fact, dates).select(
        "year", "month", "month_name",
        *[ratio(F.col(c), F.lit(1000), 1).alias(c)
          for c in ("warranty_spend", "customer_pay_revenue")],
    )
    head = headline(fact).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"),
                 F.col(name).cast("double").alias("v"))
        for i, name in enumerate(
            ("repair_orders", "fixed_first_visit_pct", "avg_csat", "customer_pay_revenue_m"))
    ])))
    by_month = [F.col("year"), F.col("month")]
    tiles = [
        _tile(head, "headline", F.col("name"), "headline", "v", 2, [F.col("i")]),
        _tile(ffv, "region", F.col("region"), "fixed_first_visit_pct", "fixed_first_visit_pct", 1,
              [F.desc("fixed_first_visit_pct"), F.col("region")]),
        _tile(cycle, "cycle", F.col("days_to_close").cast("string"), "avg_csat", "avg_csat", 2,
              [F.col("days_to_close")]),
        _tile(mix, "mix", F.col("month_name"), "warranty", "warranty_spend", 1, by_month),
        _tile(mix, "mix", F.col("month_name"), "customer", "customer_pay_revenue", 1, by_month),
        _tile(recall, "recall", F.col("model"), "recall_share_pct", "recall_share_pct", 1,
              [F.desc("recall_share_pct"), F.col("model")]),
    ]
    out = tiles[0]
    for tile in tiles[1:]:
        out = out.unionByName(tile)
    return out
