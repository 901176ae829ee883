"""The retention report: metrics, drivers, segment rates and outreach of one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bayline.operators.layout import write_report
from bayline.plans import churn, outreach, retention
from bayline.session import stage


def retention_report(
    labelled: DataFrame, settings: churn.Settings = churn.Settings(), head: int = 10
) -> dict[str, DataFrame]:
    """All parts of the report as frames; only aggregates and list heads are small."""
    spark = labelled.sparkSession
    run = churn.run(labelled, settings)
    scored = stage(run.scored, "scored")
    recs = outreach.recommendations(scored)
    mix = outreach.action_mix(recs)
    return {
        "model_metrics": churn.held_out_metrics(scored, settings),
        "retention_drivers": churn.drivers(spark, run.model),
        "service_retention_kpis": retention.retention_kpis(labelled),
        "action_mix": mix,
        "at_risk_customers": mix.agg(
            F.coalesce(F.sum("customers"), F.lit(0)).alias("at_risk_customers")),
        "sample_recommendations": outreach.report_head(recs, head),
    }


def save_report(report: dict[str, DataFrame], path: str) -> None:
    for name, df in report.items():
        write_report(df, f"{path}/{name}")
