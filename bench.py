"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR    folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS      local threads (default 8)
BENCH_QUERIES   comma-separated names (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures.queries import QUERIES  # noqa: E402

HEADLINE = [
    "daily_issue_field_history",
    "daily_status_category",
    "timestamp_issue_field_history",
    "transition_direction",
    "cumulative_flow",
    "issue_enhanced",
    "project_enhanced",
    "user_enhanced",
    "daily_sprint_issue_history",
    "sprint_enhanced",
    "order_status_transitions",
    "order_ffill_daily_scd",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldtrail-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.maxPartitionBytes", "4m")
        # Small inputs would otherwise end up in one or two tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in names:
        run(spark, name, folder)  # compiles and warms up
        times[name] = round(run(spark, name, folder), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
