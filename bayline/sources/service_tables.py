"""The supplied star tables read as service-operations sources (mapping in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bayline.operators.gates import NEAR

# End of the observed period; the feature view is computed as of this day.
AS_OF = "2001-12-31"


# Declared, so that no job has to read file footers before a query can be planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


def two_digits(value: F.Column) -> F.Column:
    """A non-negative double holding an amount with two digits, as an exact decimal.

    Goes through whole cents: Spark turns a double into a decimal by way of its text, which
    costs several times as much.
    """
    cents = F.floor(value * 100 + 0.5).cast("decimal(16,0)")
    return (cents * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(18,2)")


def _service_type() -> F.Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", "recall")
        .when(priority == "2-HIGH", "warranty_repair")
        .when(priority == "3-MEDIUM", "scheduled_maintenance")
        .when(priority == "4-NOT SPECIFIED", "customer_pay_repair")
        .when(F.col("l_partkey") % 89 == 0, "unknown")
        .otherwise("diagnostic")
    )


def _days_to_close() -> F.Column:
    rest = F.col("l_linenumber") % 5
    return (
        F.when(rest == 0, 1).when(rest == 1, 2).when(rest == 2, 3).when(rest == 3, 5).otherwise(8)
    )


def _ro_number() -> F.Column:
    return F.concat(F.lit("RO"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))


# The tables carry no row position; these columns are unique together and give an order.
_ORDER = ("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _arrival() -> F.Column:
    return F.struct(*_ORDER)


def _arranged(rows: DataFrame, wanted: bool, *others: str) -> DataFrame:
    """The rows dealt out and sorted by their arrival, as the tables have them: derived columns would be wider."""
    if not wanted:
        return rows
    return rows.select(*_ORDER, *others).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)


def _near(wanted: bool) -> list[F.Column]:
    # The order number begins with the order's key, by which the lines are joined to the orders.
    return [F.col("l_orderkey").alias(NEAR)] if wanted else []


def raw_orders(
    spark: SparkSession, sf_dir: str, contacts: bool = False, near: bool = False, in_order: bool = False
) -> DataFrame:
    """Repair orders before validation; `contacts` adds the customer's e-mail and phone.

    `near` adds the column by which they lie together, for the gates; `in_order` has the rows lie by arrival.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    extra, known = [], []
    if contacts:
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        known = ["c_custkey", "c_name"]
        extra = [
            F.concat("c_name", F.lit("@example.test")).alias("customer_email"),
            F.concat(F.lit("555-"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
            .alias("customer_phone"),
        ]
    price, tax = two_digits(F.col("l_extendedprice")), two_digits(F.col("l_tax"))
    rows = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = _arranged(rows, in_order, "l_tax", "l_returnflag", "o_custkey", "o_orderpriority", *known)
    return rows.select(
        _ro_number().alias("ro_number"),
        F.col("l_suppkey").cast("string").alias("dealer_id"),
        F.when(F.col("l_partkey") % 97 != 0, F.col("l_partkey").cast("string")).alias("vin"),
        _service_type().alias("service_type"),
        F.col("l_shipdate").cast("date").alias("open_date"),
        _days_to_close().alias("days_to_close"),
        F.when(F.col("l_quantity") == 50, -price).otherwise(price)
        .cast("decimal(18,2)").alias("labor_amount"),
        (price * tax.cast("decimal(4,2)")).cast("decimal(18,2)").alias("parts_amount"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "warranty")
        .otherwise("customer").alias("pay_type"),
        (F.col("l_returnflag") == "R").cast("int").alias("repeat_repair_flag"),
        F.col("o_custkey").alias("customer_id"),
        *extra,
        _arrival().alias("arrival"),
        *_near(near),
    )


def surveys(spark: SparkSession, sf_dir: str, near: bool = False, in_order: bool = False) -> DataFrame:
    """Nested survey documents for every third order; a repeated ro_number has several."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_orderkey") % 3 == 0)
    lines = _arranged(lines, in_order, "l_returnflag", "l_linestatus")
    score = (F.lit(1) + F.col("l_quantity") % 5).cast("int")
    return lines.select(
        F.concat(F.lit("SV-"), _ro_number(), F.lit("-"), F.col("l_partkey")).alias("survey_id"),
        _ro_number().alias("ro_number"),
        F.struct(
            score.alias("satisfaction"),
            (score >= 4).alias("would_recommend"),
            (F.col("l_returnflag") == "A").alias("comments_present"),
        ).alias("response"),
        F.when(F.col("l_linestatus") == "O", "email").otherwise("sms").alias("channel"),
        _arrival().alias("arrival"),
        *_near(near),
    )


def dealers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("dealer_id"),
            F.col("s_name").alias("dealer_name"),
            F.col("r_name").alias("region"),
            (F.lit(4) + F.col("s_suppkey") % 21).cast("int").alias("service_bays"),
            F.col("s_nationkey").alias("nation_key"),
            F.col("s_suppkey").alias("arrival"),
        )
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.lit(1992) + F.col("p_size") % 8
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("vin"),
        F.col("p_type").alias("model"),
        year.cast("int").alias("model_year"),
        F.when(F.col("p_size") % 3 == 2, 60).otherwise(36).alias("warranty_months"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("in_service_date"),
        F.col("p_partkey").alias("arrival"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known customers with their consent state; negative balances stand for opt-outs."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"),
        F.concat("c_name", F.lit("@example.test")).alias("customer_email"),
        F.concat(F.lit("555-"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
        .alias("customer_phone"),
        F.when(F.col("c_acctbal") < 0, "ccpa_opt_out")
        .when(F.col("c_mktsegment") == "MACHINERY", "unknown")
        .otherwise("consented").alias("consent_status"),
        F.col("c_nationkey").alias("nation_key"),
    )


def distance(customer: F.Column, dealer: F.Column) -> F.Column:
    """Stand-in for the way to the dealer, which no table has."""
    return F.abs(customer["nation_key"] - dealer["nation_key"]) * 10


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of whole orders, for the nested form of the fact."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return table(spark, sf_dir, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.concat(F.lit("RO"), F.col("l_orderkey")).alias("ro_number"),
        F.col("o_orderdate").cast("date").alias("service_date"),
        (F.col("o_custkey") % 100).alias("dealer_key"),
        F.concat(F.lit("OP"), F.col("l_linenumber")).alias("op_code"),
        F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("description"),
        two_digits(F.col("l_quantity")).alias("labor_hours"),
        two_digits(F.col("l_extendedprice")).alias("amount"),
        _arrival().alias("arrival"),
    )
