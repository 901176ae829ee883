"""Customer retention: feature view, labelled history and segment rates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from bayline.functions import month_boundaries, ratio, share_pct, year_boundaries


def _day(as_of) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


# Per-visit measures whose sums, maxima and counts can be combined again.
_SUMS = ("visits", "score_sum", "score_count", "wait_sum", "repeat_sum", "paid", "spend")
_MAXIMA = ("last_visit", "had_recall")


def _visit_totals(when: Column | None = None) -> list[Column]:
    """Aggregates over visits, optionally only those where `when` holds."""

    def only(col: Column) -> Column:
        return col if when is None else F.when(when, col)

    paid = F.when(F.col("pay_type") == "customer", F.col("total_amount")).otherwise(0)
    score = only(F.col("satisfaction_score"))
    return [
        F.count(only(F.lit(1))).alias("visits"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_count"),
        F.sum(only(F.col("days_to_close"))).alias("wait_sum"),
        F.sum(only(F.col("repeat_repair_flag"))).alias("repeat_sum"),
        F.sum(only(paid)).alias("paid"),
        F.sum(only(F.col("total_amount"))).alias("spend"),
        F.max(only(F.col("service_date"))).alias("last_visit"),
        F.max(only((F.col("service_type") == "recall").cast("int"))).alias("had_recall"),
    ]


def _combined_totals() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS] + [F.max(c).alias(c) for c in _MAXIMA]


def _features(totals: DataFrame) -> DataFrame:
    """Turn visit totals into the model's features."""
    visits = F.col("visits")
    share = F.try_divide(F.col("paid").cast("decimal(22,2)"), F.col("spend").cast("decimal(22,2)"))
    return totals.withColumns({
        "prior_visits": visits,
        "avg_satisfaction": ratio(F.col("score_sum"), F.col("score_count"), 6),
        "avg_wait_days": ratio(F.col("wait_sum"), visits, 6),
        "repeat_repair_rate": ratio(F.col("repeat_sum"), visits, 6),
        "customer_pay_share": F.round(share, 6),
        "total_service_spend": F.col("spend"),
    })


def _aged(df: DataFrame, as_of: Column, warranty_by_contract: bool = False) -> DataFrame:
    age = year_boundaries(F.col("in_service_date"), as_of)
    if warranty_by_contract:
        covered = month_boundaries(F.col("in_service_date"), as_of) <= F.col("warranty_months")
    else:
        covered = age <= 3
    return (
        df.withColumn("vehicle_age", age)
        .withColumn("in_warranty", covered.cast("int"))
        .withColumn("months_since_last_service", month_boundaries(F.col("last_visit"), as_of))
    )


def retention_features(
    fact: DataFrame, customers: DataFrame, vehicles: DataFrame, as_of=None,
    warranty_by_contract: bool = False,
) -> DataFrame:
    """Features per customer, model and in-service date.

    Orders are totalled per customer and vehicle before the dimensions are joined, so the joins
    move one row per pair and a customer or vehicle with very many orders is combined early.
    `in_warranty` means at most three calendar years old; `warranty_by_contract` uses the
    vehicle's own warranty months instead.
    """
    keys = ["customer_key", "model", "in_service_date"]
    if warranty_by_contract:
        keys.append("warranty_months")
    pairs = fact.groupBy("customer_key", "vehicle_key").agg(*_visit_totals())
    grouped = (
        pairs.join(customers.select("customer_key"), "customer_key")
        .join(vehicles.select("vehicle_key", *keys[1:]), "vehicle_key")
        .groupBy(*keys)
        .agg(*_combined_totals())
    )
    return _aged(_features(grouped), _day(as_of), warranty_by_contract).select(
        "customer_key", "model", "in_service_date", "vehicle_age", "in_warranty", "prior_visits",
        "months_since_last_service", "avg_satisfaction", "avg_wait_days", "repeat_repair_rate",
        "customer_pay_share", "total_service_spend", "had_recall",
    )


def service_history(
    fact: DataFrame, customers: DataFrame, vehicles: DataFrame, dealers: DataFrame, cutoff,
    horizon_months: int, distance: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """One labelled row per customer: features up to `cutoff`, label from the period after it.

    `retained_next_period` is 1 when the customer came back within the horizon. Features and
    label come out of one aggregation pass; dealer, region and vehicle are those of the last
    visit before the cutoff. `distance` computes the way to the dealer from the customer's and the
    dealer's row (as structs); without it the column is NULL.
    """
    cut = _day(cutoff)
    before = F.col("service_date") <= cut
    back = (F.col("service_date") > cut) & (
        F.col("service_date") <= F.add_months(cut, horizon_months))
    visit = F.struct("service_date", "ro_number", "dealer_key", "vehicle_key")
    per_customer = (
        fact.groupBy("customer_key")
        .agg(
            *_visit_totals(before),
            F.max(F.when(before, visit)).alias("last"),
            F.coalesce(F.max(back.cast("int")), F.lit(0)).alias("retained_next_period"),
        )
        .where(F.col("visits") > 0)
        .select("*", "last.dealer_key", "last.vehicle_key")
        .drop("last")
    )
    joined = (
        per_customer
        .join(customers.select("customer_key", F.struct("*").alias("_customer")), "customer_key")
        .join(dealers.select("dealer_key", "dealer_id", "region", F.struct("*").alias("_dealer")),
              "dealer_key")
        .join(vehicles.select("vehicle_key", "model", "model_year", "in_service_date"),
              "vehicle_key")
    )
    way = F.lit(None).cast("int") if distance is None else distance(F.col("_customer"), F.col("_dealer"))
    return _aged(_features(joined), cut).select(
        "customer_key", "dealer_id", "region", "model", "model_year", "vehicle_age",
        "in_warranty", "prior_visits", "months_since_last_service", "avg_satisfaction",
        "avg_wait_days", "repeat_repair_rate", "customer_pay_share",
        way.alias("distance_to_dealer_mi"),
        "total_service_spend", "had_recall", "retained_next_period",
    )


def _rate() -> list[Column]:
    kept = F.col("retained_next_period").cast("int")
    return [
        F.count("*").alias("customers"),
        share_pct(F.sum(kept), F.count("*")).alias("retention_rate_pct"),
    ]


def retention_by_region(labelled: DataFrame, dealers: DataFrame) -> DataFrame:
    """Rate by the dealer's region. Customers of dealers missing from the dimension drop out."""
    kept = F.col("retained_next_period").cast("int")
    per_dealer = labelled.groupBy("dealer_id").agg(
        F.count("*").alias("n"), F.sum(kept).alias("kept"))
    return (
        per_dealer.join(dealers.select("dealer_id", "region"), "dealer_id")
        .groupBy("region")
        .agg(
            F.sum("n").alias("customers"),
            share_pct(F.sum("kept"), F.sum("n")).alias("retention_rate_pct"),
        )
    )


def retention_by_warranty(labelled: DataFrame) -> DataFrame:
    segment = F.when(F.col("in_warranty") == 1, "In warranty").otherwise("Out of warranty")
    return labelled.groupBy(segment.alias("segment")).agg(*_rate())


def retention_kpis(labelled: DataFrame) -> DataFrame:
    """Overall rate and rates by warranty, region and model, in long form.

    The customers are counted once per combination of the three; the groupings then work on
    those few rows. An empty input still has its overall row, with rate 0.
    """
    warranty = F.when(F.col("in_warranty").cast("int") != 0, "in_warranty").otherwise(
        "out_of_warranty")
    kept = F.col("retained_next_period").cast("int")
    cells = labelled.groupBy(warranty.alias("warranty"), "region", "model").agg(
        F.count("*").alias("n"), F.sum(kept).alias("kept"))
    rates = [F.sum("n").alias("customers"), share_pct(F.sum("kept"), F.sum("n")).alias("rate")]
    names = ("warranty", "region", "model")
    sets = cells.groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names]).agg(
        *rates, *[F.grouping(n).alias(f"_{n}") for n in names])

    def chosen(value) -> Column:
        return F.coalesce(*[F.when(F.col(f"_{n}") == 0, value(n)) for n in names])

    segments = sets.select(
        chosen(F.lit).alias("dimension"), chosen(F.col).alias("segment"), "customers", "rate")
    overall = cells.agg(*rates).select(
        F.lit("overall").alias("dimension"), F.lit("all").alias("segment"), "customers", "rate")
    return overall.unionByName(segments).select(
        "dimension", "segment", F.coalesce("customers", F.lit(0)).alias("customers"),
        F.coalesce("rate", F.lit(0)).cast("decimal(5,1)").alias("retention_rate_pct"),
    )


def ordered_kpis(kpis: DataFrame) -> DataFrame:
    """Reporting order: regions by name, models by rate."""
    return kpis.orderBy(
        "dimension",
        F.when(F.col("dimension") == "model", F.col("retention_rate_pct")),
        "segment",
    )
