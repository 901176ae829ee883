import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from bayline.plans import churn, outreach, reports, retention

SETTINGS = churn.Settings(trees=15, rate=0.3)


@pytest.fixture(scope="module")
def labelled(spark):
    """Customers whose return depends on recency and warranty, by construction."""
    rng = random.Random(11)
    rows = []
    for i in range(2_000):
        age, months = rng.randint(0, 9), rng.uniform(0, 24)
        warranty, satisfaction = int(rng.random() < 0.4), rng.choice([None, 2.0, 3.0, 4.0, 5.0])
        z = 2.2 - 0.25 * months + 2.0 * warranty
        rows.append((
            i, f"D{i % 9}", f"region {i % 4}", f"model {i % 5}", 2015, float(age), float(warranty),
            float(rng.randint(1, 20)), months, satisfaction, rng.uniform(1, 9),
            rng.uniform(0, 0.5), rng.random(), rng.uniform(1, 60), rng.uniform(50, 5000),
            float(rng.random() < 0.2), int(rng.random() < 1 / (1 + math.exp(-z)))))
    return spark.createDataFrame(
        rows, "customer_key bigint, dealer_id string, region string, model string, model_year int, "
        "vehicle_age double, in_warranty double, prior_visits double, "
        "months_since_last_service double, avg_satisfaction double, avg_wait_days double, "
        "repeat_repair_rate double, customer_pay_share double, distance_to_dealer_mi double, "
        "total_service_spend double, had_recall double, retained_next_period int")


@pytest.fixture(scope="module")
def report(labelled):
    return {k: v.collect() for k, v in reports.retention_report(labelled, SETTINGS).items()}


def test_the_model_has_signal(report):
    got = report["model_metrics"][0]
    assert got.churn_roc_auc > 0.65 and got.churn_pr_auc > 0.5 and got.lift_at_10pct > 1.2


def test_the_known_drivers_come_out_on_top(report):
    drivers = [r.feature for r in report["retention_drivers"]]
    assert {"months_since_last_service", "in_warranty"} <= set(drivers[:4]) and len(drivers) == 11


def test_rates_are_bounded_and_split_by_segment(report):
    rates = {(r.dimension, r.segment): float(r.retention_rate_pct)
             for r in report["service_retention_kpis"]}
    assert all(0 <= v <= 100 for v in rates.values())
    assert rates["warranty", "in_warranty"] > rates["warranty", "out_of_warranty"]
    assert {d for d, _ in rates} == {"overall", "warranty", "region", "model"}


def test_outreach_covers_the_at_risk_customers(report):
    at_risk = report["at_risk_customers"][0].at_risk_customers
    assert at_risk == 300 == sum(r.customers for r in report["action_mix"])
    assert len(report["sample_recommendations"]) == 10
    assert all(0 <= r.churn_risk <= 1 and r.recommended_action for r in report["sample_recommendations"])


def test_the_split_is_stratified_and_order_free(spark, labelled):
    frame = churn.training_frame(labelled)
    one = churn.stratified_split(frame)
    two = churn.stratified_split(frame.repartition(3).orderBy(F.desc("total_service_spend")))
    assert one.exceptAll(two).isEmpty()
    for row in one.groupBy("churned").agg(F.avg("is_train").alias("share"), F.count("*").alias("n")).collect():
        assert abs(row.share - 0.75) * row.n <= 1


def test_report_files(labelled, tmp_path, spark):
    kpis = retention.retention_kpis(labelled)
    reports.save_report({"kpis": kpis}, str(tmp_path))
    assert len(list((tmp_path / "kpis").glob("*.json"))) == 1


def test_an_empty_history_has_an_overall_rate_of_zero(labelled):
    rows = retention.retention_kpis(labelled.where("false")).collect()
    assert [(r.dimension, r.customers, float(r.retention_rate_pct)) for r in rows] == [("overall", 0, 0.0)]


def risk_row(spark, **change):
    base = dict(customer_key=1, region="R", months_since_last_service=1, in_warranty=0,
                vehicle_age=5, avg_satisfaction=4.5, repeat_repair_rate=0.0,
                customer_pay_share=0.5, had_recall=0, churn_risk=0.5)
    row = {**base, **change}
    return spark.createDataFrame([tuple(row.values())], (
        "customer_key int, region string, months_since_last_service int, in_warranty int, "
        "vehicle_age int, avg_satisfaction double, repeat_repair_rate double, "
        "customer_pay_share double, had_recall int, churn_risk double"))


@pytest.mark.parametrize("change, action, value", [
    ({}, "personalized_service_reminder", 0.5),
    ({"months_since_last_service": 8}, "personalized_service_reminder", 0.5),
    ({"months_since_last_service": 9}, "lapsed_maintenance_reminder", 1.5),
    ({"months_since_last_service": 9, "had_recall": 1}, "lapsed_maintenance_reminder", 1.5),
    ({"had_recall": 1, "customer_pay_share": 0.9}, "recall_completion_followup", 1.5),
    ({"customer_pay_share": 0.61}, "loyalty_discount", 1.0),
    ({"in_warranty": 1, "vehicle_age": 3, "had_recall": 1}, "warranty_expiry_offer", 2.0),
    ({"avg_satisfaction": 3.4, "in_warranty": 1, "vehicle_age": 3}, "service_recovery_outreach", 2.5),
    ({"repeat_repair_rate": 0.26}, "service_recovery_outreach", 2.5),
    ({"avg_satisfaction": None}, "personalized_service_reminder", 0.5),
    ({"churn_risk": 0.1235}, "personalized_service_reminder", 0.124),
])
def test_best_action(spark, change, action, value):
    row = outreach.with_recommendation(risk_row(spark, **change), outreach.default_actions()).first()
    assert (row.recommended_action, float(row.expected_value)) == (action, value)


def test_actions_can_be_replaced(spark):
    mine = [outreach.Action("call", F.col("churn_risk") > 0.4, 7)]
    assert outreach.with_recommendation(risk_row(spark), mine).first().recommended_action == "call"


def test_warranty_by_contract_uses_the_vehicle_months(spark):
    day = dt.date(2024, 1, 1)
    fact = spark.createDataFrame(
        [(1, 1, day, "customer", "recall", 3, 0, None)],
        "customer_key int, vehicle_key int, service_date date, pay_type string, "
        "service_type string, days_to_close int, repeat_repair_flag int, satisfaction_score int",
    ).withColumn("total_amount", F.lit(0).cast("decimal(18,2)"))
    customers = spark.createDataFrame([(1,)], "customer_key int")
    vehicles = spark.createDataFrame(
        [(1, "m", dt.date(2019, 12, 31), 60)],
        "vehicle_key int, model string, in_service_date date, warranty_months int")
    row = lambda **k: retention.retention_features(
        fact, customers, vehicles, "2024-12-31", **k).first()
    assert (row().vehicle_age, row().in_warranty) == (5, 0)
    assert row(warranty_by_contract=True).in_warranty == 1
    assert row().customer_pay_share is None and row().months_since_last_service == 11
