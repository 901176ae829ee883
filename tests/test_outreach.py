"""Outreach lists: what they read."""

from pyspark.sql import functions as F

from bayline.plans import outreach


def test_the_customers_at_risk_are_computed_once(spark):
    """The selection reads stored scores; it doesn't total the visits again."""
    visits = spark.range(3000).select((F.col("id") % 100).alias("customer_key"), "id")
    scored = visits.groupBy("customer_key").agg((F.max("id") / 3000).alias("churn_risk"))
    risky = outreach.at_risk(scored, 0.15)
    plan = risky._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Range" not in plan
    assert sorted(r.customer_key for r in risky.collect()) == list(range(85, 100))
