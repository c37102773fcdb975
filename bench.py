"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revisit.session import build_session  # noqa: E402
from workload.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "analysis_appointments", "visit_days", "client_completed_visits", "monthly_performance", "active_clients",
    "client_retention", "client_cohorts", "visit_intervals", "repeat_cadence", "service_monthly",
    "identity_resolution", "constraint_violations", "load_summary", "report_rows", "clean_appointments",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "revisit-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):  # the first run also compiles the plan
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    result = {
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
