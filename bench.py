"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from indicora.plans.queries import REGISTRY  # noqa: E402
from indicora.session import build_session  # noqa: E402

HEADLINE = [
    "risk_score",
    "risk_drivers_top3",
    "risk_legacy",
    "disease_risk",
    "latest_by_series",
    "peer_compare",
    "trend_all",
    "yoy_anomalies",
    "ols_forecast",
    "customer_trend",
    "lag_features",
    "anomaly_features",
    "drift_report",
    "quality_profile",
    "contract_violations",
    "validation_report",
    "melt_years",
    "number_clean",
    "union_dedupe",
    "quantile_calibration",
    "event_routing",
    "retry_schedule",
    "dlq_envelope",
    "fact_load_new_only",
    "star_rollup",
    "alert_episodes",
    "alert_summary",
    "root_cause",
    "error_rate_5min",
    "latency_p95",
    "retention_keep",
    "deep_page",
    "regression_stump",
    # trainings and streams
    "forest_metrics",
    "iforest_scores",
    "alert_stream",
    "event_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    run("risk_score")  # start the JVM's code paths once
    times = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
