"""Declarative assertions compiled to one aggregation pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from bayline import schemas
from bayline.functions import in_domain


@dataclass(frozen=True)
class Violation:
    """Counts rows for which `bad` holds (NULL counts as not bad)."""

    name: str
    bad: Column


@dataclass(frozen=True)
class Band:
    """Share of rows for which `hit` holds, in percent, must lie in [low, high]."""

    name: str
    hit: Column
    low: float
    high: float


@dataclass(frozen=True)
class UniqueKey:
    """No two rows may share the key."""

    name: str
    keys: tuple[str, ...]


Check = Violation | Band | UniqueKey


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows (check_name, measured, passed).

    Violations and bands share a single scan. Each unique key costs one aggregation over the
    key columns, combined per map task, so copies of one key do not gather in one task.
    """
    measured = []
    for check in checks:
        if isinstance(check, Violation):
            n = F.count_if(check.bad).cast("double")
            measured.append((check.name, n, n == 0))
        elif isinstance(check, Band):
            share = F.round(F.count_if(check.hit) * 100.0 / F.count("*"), 4)
            ok = F.coalesce(share.between(check.low, check.high), F.lit(False))
            measured.append((check.name, share, ok))
    out = None
    if measured:
        out = df.agg(F.array(*[
            F.struct(F.lit(name).alias("check_name"), value.alias("measured"),
                     ok.cast("int").alias("passed"))
            for name, value, ok in measured
        ]).alias("rows")).select(F.inline("rows"))
    for check in checks:
        if isinstance(check, UniqueKey):
            repeated = df.groupBy(*check.keys).agg(F.count("*").alias("n")).where("n > 1")
            row = repeated.agg(F.count("*").cast("double").alias("measured")).select(
                F.lit(check.name).alias("check_name"), "measured",
                (F.col("measured") == 0).cast("int").alias("passed"),
            )
            out = row if out is None else out.unionByName(row)
    return out


def failed(results: DataFrame) -> DataFrame:
    return results.where(F.col("passed") == 0)


def fact_checks() -> list[Check]:
    labor, parts, total = F.col("labor_amount"), F.col("parts_amount"), F.col("total_amount")
    return [
        Violation("measures_valid",
                  (labor < 0) | (parts < 0) | total.isNull()
                  | (F.abs(total - labor - parts) > F.lit(0.01).cast("decimal(18,2)"))),
        Band("survey_coverage", F.col("satisfaction_score").isNotNull(), 25, 45),
        UniqueKey("fact_grain_unique", ("ro_number",)),
    ]


def customer_checks() -> list[Check]:
    return [
        Violation("no_raw_email", F.col("email_hash").like("%@%")),
        Violation("phone_is_four_characters", F.length("phone_last4") != 4),
        UniqueKey("customer_grain_unique", ("email_hash",)),
    ]


def reject_checks() -> list[Check]:
    return [Violation("rejects_have_reason", F.col("reason").isNull() | (F.col("reason") == ""))]


def staging_checks(service_types: Sequence[str] = schemas.SERVICE_TYPES) -> list[Check]:
    return [
        *[Violation(f"staging_{c}_not_null", F.col(c).isNull())
          for c in ("ro_number", "service_date", "dealer_key")],
        Violation("staging_amount_not_negative", ~(F.col("total_amount") >= 0)),
        Violation("staging_service_type_known", ~in_domain(F.col("service_type"), service_types)),
        UniqueKey("staging_ro_number_unique", ("ro_number",)),
    ]


def mart_checks() -> list[Check]:
    return [Violation("mart_ro_count_positive", ~(F.col("ro_count") > 0))]
