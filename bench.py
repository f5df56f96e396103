"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the default set
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandloom.plans.catalog import QUERIES  # noqa: E402
from demandloom.session import build_session  # noqa: E402

HEADLINE = [
    "daily_demand",
    "date_cascade",
    "fill_dates",
    "price_mode_week",
    "price_ladder",
    "dedup_transactions",
    "iqr_bounds",
    "price_anomalies",
    "clean_transactions",
    "zscore",
    "numeric_stats",
    "quality_profile",
    "post_validate_rows",
    "lag_rolling_features",
    "forecast_metrics",
    "ks_statistic",
    "monitoring_report",
    "daily_spine",
    "seasonal_baseline",
    "business_hours",
    "price_influence",
    "version_diff",
    "pipeline_daily",
    "folder_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        cpus,
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])  # start-up of the JVM's code caches
    seconds = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
