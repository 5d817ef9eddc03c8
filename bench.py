"""Time the headline queries and print one line of JSON.

BENCH_SF_DIR   input folder, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default 8
BENCH_QUERIES  comma-separated names, or "all"; default: the headline queries
BENCH_RUNS     timed runs after one warm-up, default 3; the median counts.
               A query whose warm-up takes over 8 seconds is timed once.

A query's time covers building its plan and running it into a sink that drops
the rows; queries that write tables or run streams include that work.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import QUERIES  # noqa: E402

HEADLINE = (
    "payload_decode",
    "topic_schema",
    "flatten_events",
    "certs_silver",
    "hunt_unique_issuer",
    "hunt_single_subject_issuer",
    "hunt_short_issuer",
    "hunt_blacklisted",
    "hunt_entropy",
    "entropy_documents",
    "route_process",
    "route_network",
    "silver_wide",
    "bronze_partitioned",
    "silver_from_bronze",
    "stream_bronze",
    "stream_fanout",
    "zorder_rewrite",
)

LONG = 8.0


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("huntlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="huntlake-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in names:
        repeats = runs if seconds(spark, name, sf_dir) < LONG else 1
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(repeats)), 3)
    spark.stop()
    result = {
        "metric": "huntlake_total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
