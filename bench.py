"""Times the headline queries; prints one JSON line.

Each query is built and run in full into the ``noop`` sink: one warm-up, then the
median of three runs. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docweave.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "cdc_parse",
    "price_parse",
    "stock_parse",
    "product_price_changelog",
    "enriched_latest",
    "enriched_changelog",
    "dedup_changelog",
    "ttl_full_pipeline",
    "index_upsert",
    "pipeline_from_messages",
    "join_completeness",
    "events_rate",
    "latency_stats",
    "stock_totals",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docweave-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
