"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of Parquet tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local cores                (default: all)
BENCH_QUERIES comma-separated names      (default: the headline list; "all" for every query)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.session import SESSION_SETTINGS  # noqa: E402
from tallyhouse.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "clean_transactions",
    "dedup_by_arrival",
    "validated_transactions",
    "validation_error_breakdown",
    "masked_transactions",
    "daily_merchant_summary",
    "risk_metrics",
    "hourly_patterns",
    "currency_breakdown",
    "merchant_kpis",
    "daily_transaction_summary",
    "data_quality_summary",
    "merchant_performance_overview",
    "comprehensive_summary",
    "read_date_range",
    "dedup_line_items",
    "daily_job_processed",
]


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tallyhouse-bench")
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    cores = str(os.cpu_count() if cpus == "*" else cpus)
    spark = (
        builder.config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, folder: str, label: str) -> tuple[float, int]:
    """Seconds and Spark jobs until every row of the result has been produced."""
    group = f"{label}-{name}"
    spark.sparkContext.setJobGroup(group, name)
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    return round(seconds, 3), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "*"))
    spark.read.parquet(f"{folder}/nation.parquet").count()

    cold, warm, jobs = {}, {}, {}
    for name in names:
        cold[name], _ = timed(spark, name, folder, "cold")
        warm[name], jobs[name] = timed(spark, name, folder, "warm")
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "jobs": jobs,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
