"""Privacy, retention and access rules as data jobs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bayline import schemas

# Classification levels from open to closed, column labels, roles.
LEVELS = ("PUBLIC", "INTERNAL", "PII_INDIRECT", "PII_DIRECT")

CATALOG: dict[str, dict[str, str]] = {
    "fact_repair_orders": {
        "ro_number": "INTERNAL",
        "total_amount": "INTERNAL",
        "satisfaction_score": "INTERNAL",
    },
    "dim_customer": {
        "email_hash": "PII_INDIRECT",
        "phone_last4": "PII_INDIRECT",
        "consent_status": "INTERNAL",
    },
    "dim_vehicle": {"vin": "PII_INDIRECT"},
}

def _internal(*columns: str) -> dict[str, str]:
    return dict.fromkeys(columns, "INTERNAL")


# Labels of every other column of the warehouse. Access needs a label: what has none is denied.
# A rejected row's text carries the contact hash, so it is labelled like that.
LABELS: dict[str, dict[str, str]] = {
    "fact_repair_orders": {
        **_internal(*schemas.FACT.fieldNames()), **CATALOG["fact_repair_orders"]},
    "dim_customer": {**_internal("customer_key"), **CATALOG["dim_customer"]},
    "dim_vehicle": {**_internal(*schemas.DIM_VEHICLE.fieldNames()), **CATALOG["dim_vehicle"]},
    "dim_dealer": _internal(*schemas.DIM_DEALER.fieldNames()),
    "dim_date": _internal(*schemas.DIM_DATE.fieldNames()),
    "dq_rejects": {**_internal("ro_number", "reason"), "raw_row": "PII_INDIRECT"},
    "etl_audit": _internal("seq", "stage", "entity", "row_count", "logged_at"),
}

ROLES: dict[str, dict] = {
    "analyst": {
        "tables": ["fact_repair_orders", "dim_dealer", "dim_vehicle", "dim_date"],
        "pii": "none",
    },
    "cx_researcher": {"tables": "all", "pii": "PII_INDIRECT"},
    "governance": {"tables": "all", "pii": "all"},
}

RAW_PII_COLUMNS = ("customer_email", "customer_phone")

# Highest level each PII grant may read.
_PII_CEILING = {"none": "INTERNAL", "PII_INDIRECT": "PII_INDIRECT", "all": "PII_DIRECT"}


class AccessDenied(PermissionError):
    pass


def apply_access(
    df: DataFrame, table: str, role: str, catalog: Mapping = LABELS, roles: Mapping = ROLES
) -> DataFrame:
    """The columns of a table a role may read; unknown roles and unlisted tables are denied.

    Columns without a label are denied to everybody; raw contact data is PII_DIRECT wherever it
    turns up.
    """
    grant = roles.get(role)
    if grant is None or (grant["tables"] != "all" and table not in grant["tables"]):
        raise AccessDenied(f"{role} may not read {table}")
    ceiling = LEVELS.index(_PII_CEILING[grant["pii"]])
    labels = catalog.get(table, {})

    def level(column: str) -> int:
        label = "PII_DIRECT" if column in RAW_PII_COLUMNS else labels.get(column)
        return len(LEVELS) if label is None else LEVELS.index(label)

    return df.select(*[c for c in df.columns if level(c) <= ceiling])


def erase_customers(customers: DataFrame, requests: DataFrame) -> DataFrame:
    """The customer dimension without the hashes asked to be deleted.

    Facts keep their surrogate keys, so no aggregate changes. Plain Parquet has no DELETE: the
    caller writes the result as the next version of the table.
    """
    return customers.join(requests.select("email_hash").distinct(), "email_hash", "left_anti")


def retention_tiers(fact: DataFrame, as_of, keep_months: int = 36) -> DataFrame:
    """Recent orders as they are; older ones only as monthly totals per dealer.

    The cut lies on a month start, so every month is on exactly one side.
    """
    cut = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), -keep_months)
    recent = fact.where(F.col("service_month") >= cut).select(
        F.lit("detail").alias("tier"), "ro_number", "service_month", "dealer_key",
        F.lit(1).cast("bigint").alias("ro_count"), "total_amount",
    )
    old = (
        fact.where(F.col("service_month") < cut)
        .groupBy("service_month", "dealer_key")
        .agg(F.count("*").alias("ro_count"), F.sum("total_amount").alias("total_amount"))
        .select(
            F.lit("monthly").alias("tier"), F.lit(None).cast("string").alias("ro_number"),
            "service_month", "dealer_key", "ro_count", "total_amount",
        )
    )
    return recent.unionByName(old)


def external_share(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Facts that may leave the organisation: those of known customers who have not opted out.

    Facts without a customer, and those of customers the dimension doesn't have (erased ones), stay
    inside. An unknown or missing consent state is no opt-out.
    """
    opted_out = F.col("consent_status").eqNullSafe("ccpa_opt_out")
    return fact.join(customers.where(~opted_out).select("customer_key"), "customer_key", "left_semi")


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def pii_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: raw contact columns in its schema, and rows whose text holds an `@`.

    Both must be 0. Each table is scanned once, and only its text columns.
    """
    parts = []
    for name, df in tables.items():
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        leaks = F.lit(False)
        for column in text:
            leaks = leaks | F.coalesce(F.col(column).contains("@"), F.lit(False))
        raw = sum(column in RAW_PII_COLUMNS for column in df.columns)
        parts.append(df.agg(F.count_if(leaks).alias("rows_with_email")).select(
            F.lit(name).alias("table_name"), F.lit(raw).alias("raw_pii_columns"),
            "rows_with_email",
        ))
    return _union(parts)


def pii_audit_of_catalog(spark: SparkSession, names: Iterable[str] | None = None) -> DataFrame:
    """The same over the tables and views the session knows."""
    wanted = names or [t.name for t in spark.catalog.listTables()]
    return pii_audit({name: spark.table(name) for name in wanted})


def catalog_conformance(
    tables: Mapping[str, DataFrame], catalog: Mapping = CATALOG
) -> DataFrame:
    """Declared against actual columns, with the number of filled values per actual column.

    `status` is conforming, undeclared (in the table only) or declared_only (in the catalog
    only). One aggregation pass per table.
    """
    parts = []
    for name, df in tables.items():
        declared = catalog.get(name, {})
        entries = [
            (c, declared.get(c, "INTERNAL"), "conforming" if c in declared else "undeclared",
             F.count(c))
            for c in df.columns
        ] + [
            (c, level, "declared_only", F.lit(0).cast("bigint"))
            for c, level in declared.items() if c not in df.columns
        ]
        parts.append(df.agg(F.array(*[
            F.struct(
                F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                F.lit(level).alias("classification"), F.lit(status).alias("status"),
                filled.alias("filled_rows"),
            )
            for c, level, status, filled in entries
        ]).alias("rows")).select(F.inline("rows")))
    return _union(parts)
