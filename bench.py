"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from sprintlens.plans import catalog
from sprintlens.session import build_session

HEADLINE = (
    "sprint_features",
    "sprint_ratio_attached",
    "sprint_counts_attached",
    "delivery_monthly",
    "sprint_features_full",
    "ndjson_nested_scan",
    "cycle_time_summary",
    "frequency_tables",
    "feature_matrix",
    "baseline_suites",
    "metric_suite",
    "threshold_sweep",
    "bootstrap_ci",
    "drift_report",
    "drift_by_year",
    "top_drivers",
    "partial_dependence",
    "risk_top30",
    "calibration_compare",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from sprintlens.plans.setup import gold_table

    times = {}

    def timed(name: str, run) -> None:
        start = time.time()
        run()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    try:
        spark.range(1000).count()
        timed("build_gold_table", lambda: gold_table(spark, folder).count())
        for name in HEADLINE:
            timed(name, lambda: catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    finally:  # what has ended counts, whatever stops the rest
        line = {
            "metric": "total_wall_time",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        }
        print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
