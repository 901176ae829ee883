"""From raw orders to the star schema."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, functions as F

from bayline import schemas
from bayline.functions import (
    calendar_attributes, date_key, money, month_start, parse_date,
)
from bayline.operators import audit, gates
from bayline.operators.ranking import with_surrogate_key
from bayline.session import COMPACT, stage


@dataclass(frozen=True)
class Sources:
    orders: DataFrame
    vehicles: DataFrame
    dealers: DataFrame
    surveys: DataFrame


@dataclass(frozen=True)
class Warehouse:
    dim_dealer: DataFrame
    dim_vehicle: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    fact_repair_orders: DataFrame
    dq_rejects: DataFrame
    etl_audit: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def _typed(df: DataFrame, schema, skip: tuple[str, ...] = ()) -> list[F.Column]:
    """Cast the columns of `df` that the target schema names, in target order."""
    return [
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema.fields if f.name in df.columns and f.name not in skip
    ]


def dim_dealer(dealers: DataFrame) -> DataFrame:
    rows = dealers.select(*_typed(dealers, schemas.DIM_DEALER), "arrival")
    return with_surrogate_key(rows, [F.col("arrival")], "dealer_key", keep=[c for c in rows.columns if c != "arrival"])


def dim_vehicle(vehicles: DataFrame) -> DataFrame:
    rows = vehicles.select(*_typed(vehicles, schemas.DIM_VEHICLE), "arrival")
    return with_surrogate_key(rows, [F.col("arrival")], "vehicle_key", keep=[c for c in rows.columns if c != "arrival"])


def _hash_bytes() -> F.Column:
    """The e-mail hash as bytes, half as long in a shuffle as its digits."""
    return F.unhex("email_hash")


def dim_customer(clean: DataFrame) -> DataFrame:
    """One row per e-mail hash, phone from the first order; raw contact data stays behind."""
    seen = (
        gates.protect_contacts(clean).select(
            _hash_bytes().alias("_hash"), "phone_last4", F.col("arrival").alias("seen_at"))
        .groupBy("_hash")
        .agg(F.min(F.struct("seen_at", "phone_last4")).alias("first"))
        .select(
            F.lower(F.hex("_hash")).alias("email_hash"), "first.phone_last4", F.lit("consented").alias("consent_status"),
            F.col("first.seen_at").alias("seen_at"),
        )
    )
    return with_surrogate_key(
        seen, [F.col("seen_at")], "customer_key", keep=["email_hash", "phone_last4", "consent_status"])


def dim_date(days: DataFrame, column: str = "open_date") -> DataFrame:
    """Calendar rows for the days that occur."""
    seen = days.select(parse_date(F.col(column)).alias("day")).distinct()
    return seen.select(*calendar_attributes(F.col("day")))


def flatten_surveys(surveys: DataFrame) -> DataFrame:
    return surveys.select(
        "survey_id", "ro_number", "channel",
        F.col("response.satisfaction").alias("satisfaction_score"),
        F.col("response.would_recommend").cast("int").alias("would_recommend"),
        F.col("response.comments_present").cast("int").alias("comments_present"),
        "arrival",
    )


def last_survey(surveys: DataFrame) -> DataFrame:
    """The latest response per order; combined per map task, so repeats stay cheap.

    The grouping also tells Catalyst the result is unique per order number, so it drops the
    left join to it from any query that uses neither score. A column `NEAR` of the surveys is kept.
    """
    near = gates.near(surveys)
    answers = surveys.select(
        "ro_number", "arrival", F.col("response.satisfaction").alias("satisfaction_score"),
        F.col("response.would_recommend").cast("int").alias("would_recommend"), *near)
    return (
        answers
        .groupBy("ro_number")
        .agg(F.max_by(F.struct("satisfaction_score", "would_recommend"), F.col("arrival"))
             .alias("last"), *[F.min(c).alias(c) for c in near])
        .select("ro_number", "last.satisfaction_score", "last.would_recommend", *near)
    )


def with_survey(orders: DataFrame, surveys: DataFrame) -> DataFrame:
    """Scores of the last survey, NULL where nobody answered.

    Where both have a column `NEAR`, the surveys go to where the orders lie.
    """
    last = last_survey(surveys)
    if gates.near(orders) and gates.near(surveys):
        return orders.join(last, [gates.NEAR, "ro_number"], "left")
    return orders.join(last.drop(gates.NEAR), "ro_number", "left")


# What `measures` reads.
MEASURED = ("open_date", "service_type", "pay_type", "days_to_close", "labor_amount", "parts_amount", "repeat_repair_flag")


def measures() -> list[F.Column]:
    """Typed, derived columns every form of the fact shares."""
    labor, parts = money(F.col("labor_amount")), money(F.col("parts_amount"))
    day = parse_date(F.col("open_date"))
    return [
        date_key(day).alias("open_date_key"),
        day.alias("service_date"),
        month_start(day).alias("service_month"),
        F.col("service_type"),
        F.col("pay_type"),
        F.col("days_to_close").try_cast("int").alias("days_to_close"),
        labor.alias("labor_amount"),
        parts.alias("parts_amount"),
        (labor + parts).cast(schemas.MONEY).alias("total_amount"),
        F.col("repeat_repair_flag").try_cast("int").alias("repeat_repair_flag"),
    ]


def conform_fact(
    clean: DataFrame, dealers: DataFrame, vehicles: DataFrame, customers: DataFrame,
    surveys: DataFrame,
) -> DataFrame:
    """Clean orders with their surrogate keys and survey scores.

    Only left joins: an unknown dealer or vehicle keeps its row with a NULL key, for
    `orphan_rejects` and `order_keys` to deal with. No side is forced to broadcast; the dimensions are stored
    tables, so Spark picks broadcast or shuffle from their real size and splits skewed keys. Derived
    columns come after the joins, whose shuffles then carry what they are derived from only.
    """
    base = gates.protect_contacts(clean).select("ro_number", "dealer_id", "vin", "email_hash", *MEASURED)
    found = (
        base.join(customers.select("email_hash", "customer_key"), "email_hash", "left")
        .join(dealers.select("dealer_id", "dealer_key"), "dealer_id", "left")
        .join(vehicles.select("vin", "vehicle_key"), "vin", "left")
        .withColumn(NUMBER, F.coalesce("ro_number", F.lit("")))
    )
    # Surveys come last, by the column the surrogate keys are joined by, so that both take one shuffle.
    return _scored(found, surveys, "ro_number", "dealer_key", "vehicle_key", "customer_key", NUMBER)


def _scored(found: DataFrame, surveys: DataFrame, *names: str) -> DataFrame:
    """The named columns, the measures and the survey scores of orders that carry `NUMBER`."""
    scores = last_survey(surveys.drop(gates.NEAR)).withColumnRenamed("ro_number", NUMBER)
    answered = F.col("ro_number").isNotNull()
    return found.join(scores, NUMBER, "left").select(
        *names, *measures(), *[F.when(answered, F.col(c)).alias(c) for c in ("satisfaction_score", "would_recommend")])


def _is_orphan() -> F.Column:
    return F.col("dealer_key").isNull() | F.col("vehicle_key").isNull()


def orphan_rejects(clean: DataFrame, dealers: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Quarantine rows for clean orders whose dealer or vehicle no dimension has.

    Looks at the three columns it needs, so the wide fact does not have to be stored for it.
    """
    looked_up = (
        clean.select("ro_number", "dealer_id", "vin")
        .join(dealers.select("dealer_id", "dealer_key"), "dealer_id", "left")
        .join(vehicles.select("vin", "vehicle_key"), "vin", "left")
    )
    return resolved_orphans(looked_up)


def resolved_orphans(looked_up: DataFrame) -> DataFrame:
    """The quarantine rows among looked-up orders (`resolve_dimensions`)."""
    return looked_up.where(_is_orphan()).select(
        "ro_number",
        F.concat_ws(
            ",",
            F.when(F.col("dealer_key").isNull(), "orphan_dealer"),
            F.when(F.col("vehicle_key").isNull(), "orphan_vehicle"),
        ).alias("reason"),
        F.to_json(
            F.struct("ro_number", "dealer_id", "vin"), {"ignoreNullFields": "false"}
        ).alias("raw_row"),
    )


def order_keys(clean: DataFrame, orphans: DataFrame) -> DataFrame:
    """(ro_number, ro_key) of the orders that become facts, numbered in arrival order.

    Only numbers and arrivals are sorted and written; an order number is clean once at most.
    """
    numbered = clean.select("ro_number", "arrival").join(
        orphans.select(F.col("ro_number").alias("_orphan")), F.col("ro_number").eqNullSafe(F.col("_orphan")), "left_anti")
    return with_surrogate_key(numbered, [F.col("arrival")], "ro_key", keep=["ro_number"])


def resolve_dimensions(
    clean: DataFrame, dealers: DataFrame, vehicles: DataFrame, customers: DataFrame
) -> DataFrame:
    """What the dimensions know of each clean order, by its number: three keys, NULL where there is no member.

    Only numbers and natural keys go through the joins. The result is stored, so that orphans and the fact
    share it and the joins' shuffles are gone before the wide rows move; the natural keys stay for orphans only.
    """
    orders = gates.protect_contacts(clean).select("ro_number", "dealer_id", "vin", _hash_bytes().alias("_hash"))
    found = (
        orders.join(customers.select(_hash_bytes().alias("_hash"), "customer_key"), "_hash", "left").drop("_hash")
        .join(vehicles.select("vin", "vehicle_key"), "vin", "left")
        .join(dealers.select("dealer_id", "dealer_key"), "dealer_id", "left")
    )
    return stage(found.select(
        "ro_number", "dealer_key", "vehicle_key", "customer_key",
        *[F.when(_is_orphan(), F.col(c)).alias(c) for c in ("dealer_id", "vin")]), "resolved", COMPACT)


def numbered_fact(clean: DataFrame, resolved: DataFrame, keys: DataFrame, surveys: DataFrame) -> DataFrame:
    """The clean orders that have a key, with it, what `resolve_dimensions` has found and their survey scores.

    Orders, keys, members and surveys meet by the order number, each after one shuffle; columns are
    derived behind it. A missing number and an empty one are the same, but for surveys.
    """
    def by_number(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(F.coalesce("ro_number", F.lit("")).alias(NUMBER), *columns)

    found = by_number(keys, "ro_key").join(
        by_number(resolved, "dealer_key", "vehicle_key", "customer_key"), NUMBER)
    orders = by_number(clean, "ro_number", *MEASURED).join(found, NUMBER)
    return _scored(orders, surveys, "ro_key", "ro_number", "dealer_key", "vehicle_key", "customer_key")


def keyed_fact(conformed: DataFrame, keys: DataFrame) -> DataFrame:
    """The conformed orders that have a key, with it. A missing number and an empty one are the same."""
    keys = keys.select("ro_key", F.coalesce("ro_number", F.lit("")).alias(NUMBER))
    return conformed.join(keys, NUMBER).select("ro_key", *FACT_COLUMNS)


NUMBER = "_number"  # the order number as it is joined by
FACT_COLUMNS = tuple(f.name for f in schemas.FACT.fields if f.name != "ro_key")


def build_warehouse(sources: Sources, on_orphan: str = "quarantine") -> Warehouse:
    """The whole batch run. `on_orphan` is `quarantine` (keep as rejects) or `fail`.

    The gated orders are read by the dimensions, the fact, the rejects and the audit, so they
    are staged once, and so are the members they refer to. The fact is computed when it is stored: the
    keys it takes are numbered apart. Contact data is hashed before anything is staged.
    """
    gated = stage(gates.protect_contacts(gates.gate_orders(sources.orders)), "gated", COMPACT)
    clean = gates.passed(gated)
    dealer, vehicle = dim_dealer(sources.dealers), dim_vehicle(sources.vehicles)
    customer = dim_customer(clean)
    resolved = resolve_dimensions(clean, dealer, vehicle, customer)
    orphans = stage(resolved_orphans(resolved), "orphans")
    if on_orphan == "fail" and not orphans.isEmpty():
        raise ValueError("orders refer to dealers or vehicles the dimensions do not have")
    keys = order_keys(clean, orphans)
    trail = audit.etl_audit(
        gated, sources.vehicles, sources.dealers, sources.surveys, orphans, keys)
    return Warehouse(
        dim_dealer=dealer,
        dim_vehicle=vehicle,
        dim_customer=customer,
        dim_date=dim_date(clean),
        fact_repair_orders=numbered_fact(clean, resolved, keys, sources.surveys),
        dq_rejects=gates.quarantine(gated).unionByName(orphans),
        etl_audit=trail,
    )
