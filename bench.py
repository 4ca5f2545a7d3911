"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.catalog import ENTRIES  # noqa: E402

HEADLINE = (
    "trailing_window_winner",
    "split_window_winner",
    "median_variety",
    "below_benchmark_percentage",
    "approx_statistics",
    "exact_statistics",
    "comparison_summary",
    "raw_trailing_winners",
    "raw_percentile_comparison",
)


def run(spark: SparkSession, name: str, folder: str) -> float:
    started = time.perf_counter()
    ENTRIES[name].build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, folder)
        times[name] = round(run(spark, name, folder), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries", "value": total, "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
