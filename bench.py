"""Times the headline queries and prints one JSON line.

Each query runs to completion into a no-op sink, so nothing is collected. `warehouse` is the
whole batch run: gates, dimensions, fact, rejects and audit, written out.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from bayline.operators import layout  # noqa: E402
from bayline.plans.star import star  # noqa: E402
from bayline.plans.warehouse import build_warehouse  # noqa: E402
from bayline.queries import QUERIES  # noqa: E402
from bayline.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "dq_clean_orders", "dq_rejects", "etl_audit", "dq_checks", "fact_repair_orders",
    "kpi_fixed_first_visit", "kpi_dealer_csat_top10", "kpi_pay_mix_by_month",
    "kpi_throughput_per_bay", "kpi_csat_by_cycle_time", "kpi_recall_share", "kpi_headline",
    "dashboard_tiles", "mart_monthly_dealer_revenue", "layout_roundtrip", "pruned_scan",
    "retention_features", "customer_service_history", "retention_kpis", "at_risk_by_region",
    "outreach_action_mix", "metric_auc", "lift_at_k", "stream_valid_events",
    "stream_monthly_mart", "stream_dedup", "churn_metrics",
]


def warehouse(spark, sf_dir):
    built = build_warehouse(star(spark, sf_dir).sources())
    layout.publish(built.tables(), scratch_path(spark, "warehouse"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    # Let the JVM load and compile its classes before anything is timed.
    for name in ("dq_rejects", "kpi_dealer_csat_top10", "stream_valid_events"):
        run(QUERIES[name](spark, sf_dir))

    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    if not chosen:
        start = time.perf_counter()
        warehouse(spark, sf_dir)
        seconds["warehouse"] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
