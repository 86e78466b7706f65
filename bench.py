"""Seconds per headline query, the better of two runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from parity.queries import QUERIES
from tidelot.session import builder

HEADLINE = [
    "dedup_first", "quality_per_lot", "hourly_truth", "same_hour_history", "asof_lag", "asof_forecast",
    "nearest_label", "build_features", "latest_anchor", "batch_complete", "changed_count",
    "passenger_day_features", "codeshare_collapse", "flight_day_features", "holiday_flags", "build_day",
    "forecast_metrics", "eval_summary_nextday",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        builder("bench").master(f"local[{cpus}]")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        # Test data are a few megabytes: let small shuffles keep all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["max_cursor"](spark, sf_dir).collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
