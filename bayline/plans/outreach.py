"""Rule-based outreach for the customers most likely to leave."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from bayline.operators.ranking import top_fraction_per_group, top_n_per_group
from bayline.operators.selection import best_fraction
from bayline.session import stage


@dataclass(frozen=True)
class Action:
    name: str
    applies: Column
    value: int


def default_actions(satisfaction_below: float = 3.5, repeat_above: float = 0.25) -> list[Action]:
    """The rule table. Names, thresholds and values are fixed values; order breaks ties."""
    return [
        Action("lapsed_maintenance_reminder", F.col("months_since_last_service") > 8, 3),
        Action("warranty_expiry_offer",
               (F.col("in_warranty") == 1) & (F.col("vehicle_age") >= 3), 4),
        Action("service_recovery_outreach",
               (F.col("avg_satisfaction") < satisfaction_below)
               | (F.col("repeat_repair_rate") > repeat_above), 5),
        Action("loyalty_discount", F.col("customer_pay_share") > 0.6, 2),
        Action("recall_completion_followup", F.col("had_recall") == 1, 3),
    ]


DEFAULT_ACTION, DEFAULT_VALUE = "personalized_service_reminder", 1


def _exact(score: str) -> Column:
    return F.col(score).cast("decimal(20,12)")


def with_recommendation(
    scored: DataFrame, actions: Sequence[Action], score: str = "churn_risk"
) -> DataFrame:
    """Best eligible action and its expected value per row.

    The best action has the highest value, the earlier one on ties. That order is known before
    any row is read, so it becomes one CASE chain.
    """
    by_value = sorted(actions, key=lambda a: -a.value)  # stable: table order on ties
    name, value = F.lit(DEFAULT_ACTION), F.lit(DEFAULT_VALUE)
    for action in reversed(by_value):
        eligible = F.coalesce(action.applies, F.lit(False))
        name = F.when(eligible, F.lit(action.name)).otherwise(name)
        value = F.when(eligible, F.lit(action.value)).otherwise(value)
    # The unrounded score is multiplied; decimals make the rounding exact.
    return scored.withColumn("recommended_action", name).withColumn(
        "expected_value", F.round(_exact(score) * value, 3)
    )


def at_risk(
    scored: DataFrame, fraction: float = 0.15, score: str = "churn_risk",
    key: str = "customer_key",
) -> DataFrame:
    """The given fraction of customers with the highest score; ties go by key.

    The scored customers are stored first: looking for the cut and selecting by it both read them,
    and what they come from, the fact as a rule, is far larger.
    """
    return best_fraction(stage(scored, "scored"), fraction, score, key)


def recommendations(
    scored: DataFrame, actions: Sequence[Action] | None = None, fraction: float = 0.15
) -> DataFrame:
    """One row per at-risk customer; the region is carried for the regional call lists."""
    chosen = with_recommendation(at_risk(scored, fraction), actions or default_actions())
    return chosen.select(
        "customer_key", "region", F.round(_exact("churn_risk"), 3).alias("churn_risk"),
        "recommended_action", "expected_value", F.col("churn_risk").alias("_score"),
    )


def report_head(recs: DataFrame, n: int = 20) -> DataFrame:
    return recs.orderBy(F.desc("_score"), "customer_key").limit(n).drop("_score")


def action_mix(recs: DataFrame) -> DataFrame:
    return recs.groupBy("recommended_action").agg(F.count("*").alias("customers"))


def at_risk_by_group(
    scored: DataFrame, group: str = "region", n: int = 500, key: str = "customer_key"
) -> DataFrame:
    """The n riskiest rows of each group, exact, without sorting a whole group in one task."""
    return top_n_per_group(scored, group, [F.desc("churn_risk"), F.asc(key)], key, n)


def at_risk_share_by_group(
    scored: DataFrame, group: str = "region", fraction: float = 0.1, key: str = "customer_key"
) -> DataFrame:
    """The riskiest fraction of each group instead of a fixed number of rows."""
    return top_fraction_per_group(
        scored, group, [F.desc("churn_risk"), F.asc(key)], fraction)
