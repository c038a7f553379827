"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of Parquet tables  (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default 8)
BENCH_QUERIES  comma-separated query names (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from monthfusion.catalogue import QUERIES  # noqa: E402

HEADLINE = (
    "gold_fusion",
    "gold_fusion_left_joins",
    "silver_collapse",
    "silver_collapse_conflicting",
    "group_distinct_max",
    "key_universe",
    "consistency_flags",
    "expect_gold",
    "publish_on_pass",
    "validate_numeric",
    "validate_report",
    "validate_all",
    "contract_flags",
    "bronze_stream_ingest",
    "bronze_rescued_data",
    "update_from_files",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("monthfusion-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query pays for starting the session and loading Spark's classes,
    # so one query runs untimed.
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
