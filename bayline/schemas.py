"""Declared schemas and value domains. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# The domains the source systems agreed on.
SERVICE_TYPES = (
    "scheduled_maintenance",
    "warranty_repair",
    "customer_pay_repair",
    "recall",
    "diagnostic",
)
PAY_TYPES = ("warranty", "customer")
CONSENT_STATES = ("ccpa_opt_out", "consented", "unknown")


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Landing files carry text only; types are applied by the gates and builders.
ORDERS_CSV = _text(
    "ro_number", "dealer_id", "vin", "service_type", "open_date", "days_to_close",
    "labor_amount", "parts_amount", "pay_type", "customer_email", "customer_phone",
    "repeat_repair_flag",
)
VEHICLES_CSV = _text("vin", "model", "model_year", "warranty_months", "in_service_date")
DEALERS_CSV = _text("dealer_id", "dealer_name", "region", "service_bays")

SURVEYS_JSON = T.StructType([
    T.StructField("survey_id", T.StringType()),
    T.StructField("ro_number", T.StringType()),
    T.StructField("response", T.StructType([
        T.StructField("satisfaction", T.IntegerType()),
        T.StructField("would_recommend", T.BooleanType()),
        T.StructField("comments_present", T.BooleanType()),
    ])),
    T.StructField("channel", T.StringType()),
])

# The churn features in model order.
FEATURES = (
    "vehicle_age", "in_warranty", "prior_visits", "months_since_last_service",
    "avg_satisfaction", "avg_wait_days", "repeat_repair_rate", "customer_pay_share",
    "distance_to_dealer_mi", "total_service_spend", "had_recall",
)
HISTORY_CSV = _text(
    "customer_key", "dealer_id", "region", "model", "model_year", *FEATURES,
    "retained_next_period",
)

# One service event as it is stored after the stream has accepted it.
SERVICE_EVENT = T.StructType([
    T.StructField("ro_number", T.StringType()),
    T.StructField("dealer_key", T.IntegerType()),
    T.StructField("service_date", T.DateType()),
    T.StructField("service_type", T.StringType()),
    T.StructField("total_amount", MONEY),
    T.StructField("satisfaction_score", T.IntegerType()),
])
DEAD_LETTER = _text("raw", "error")
MONTHLY_MART = T.StructType([
    T.StructField("month", T.DateType()),
    T.StructField("dealer_key", T.IntegerType()),
    T.StructField("ro_count", T.LongType()),
    T.StructField("total_revenue", T.DecimalType(28, 2)),
    T.StructField("score_sum", T.LongType()),
    T.StructField("score_count", T.LongType()),
])

DIM_DEALER = T.StructType([
    T.StructField("dealer_key", T.LongType()),
    T.StructField("dealer_id", T.StringType()),
    T.StructField("dealer_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("service_bays", T.IntegerType()),
])
DIM_VEHICLE = T.StructType([
    T.StructField("vehicle_key", T.LongType()),
    T.StructField("vin", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("model_year", T.IntegerType()),
    T.StructField("warranty_months", T.IntegerType()),
    T.StructField("in_service_date", T.DateType()),
])
DIM_CUSTOMER = T.StructType([
    T.StructField("customer_key", T.LongType()),
    T.StructField("email_hash", T.StringType()),
    T.StructField("phone_last4", T.StringType()),
    T.StructField("consent_status", T.StringType()),
])
DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("is_weekend", T.IntegerType()),
])
FACT = T.StructType([
    T.StructField("ro_key", T.LongType()),
    T.StructField("ro_number", T.StringType()),
    T.StructField("dealer_key", T.LongType()),
    T.StructField("vehicle_key", T.LongType()),
    T.StructField("customer_key", T.LongType()),
    T.StructField("open_date_key", T.IntegerType()),
    T.StructField("service_date", T.DateType()),
    T.StructField("service_month", T.DateType()),
    T.StructField("service_type", T.StringType()),
    T.StructField("pay_type", T.StringType()),
    T.StructField("days_to_close", T.IntegerType()),
    T.StructField("labor_amount", MONEY),
    T.StructField("parts_amount", MONEY),
    T.StructField("total_amount", MONEY),
    T.StructField("repeat_repair_flag", T.IntegerType()),
    T.StructField("satisfaction_score", T.IntegerType()),
    T.StructField("would_recommend", T.IntegerType()),
])
