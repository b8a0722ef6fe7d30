"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times; the median counts.
Results are consumed by the no-op sink, so nothing is sent to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from drayline.registry import QUERIES
from drayline.session import build_session

HEADLINE = [
    "order_trips",
    "truck_activity",
    "otd",
    "district_heatmap",
    "fleet_utilization",
    "stg_orders",
    "stg_telemetry",
    "merge_composite_key",
    "insert_if_absent",
    "metric_numeric_column",
    "metric_freshness",
    "all_columns_anomalies",
    "dimension_anomalies",
    "check_sequential_values",
    "check_equality",
    "deduplicate",
    "unpivot",
    "model_run_results",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "drayline-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "4g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for i in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
