"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR names the input (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from pyspark.sql import SparkSession

from fleetwatt.queries import QUERIES

HEADLINE = [
    "a06_write_roundtrip",
    "b07_staging",
    "b16_violations_mart",
    "c09_by_system",
    "c11_critical_count",
    "d04_soh",
    "d13_thermal_summary",
    "d16_isolation_outliers",
    "e09_monthly_report",
    "e13_quality_gate",
    "x01_missing_counts",
    "x03_round_trip_eff",
    "x07_dr_baseline",
    "x09_sustained_episodes",
    "x12_energy_rollup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fleetwatt-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("sum(value)").collect()  # start-up
    seconds = {}
    for key in HEADLINE:
        started = time.perf_counter()
        # Every row and column is computed, and nothing is written or collected.
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - started, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "raw_rows": rows,
            }
        )
    )
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)


if __name__ == "__main__":
    main()
