"""Two short jobs beside the daily run: ingest a table, list its violations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetwatt.config import JOB, GridCode
from fleetwatt.operators.quality import QualityGateError, conformance, ingest_stats
from fleetwatt.operators.violations import beyond_limits, violation_count, wide_violations
from fleetwatt.schema import TELEMETRY_SCHEMA
from fleetwatt.sources.readings import (
    read_telemetry,
    with_ingestion_ts,
    write_telemetry,
    write_violations,
)


def run_ingest(
    df: DataFrame, target: str, as_of: str | datetime | None = None, by: str = "date"
) -> dict:
    """Check, stamp and store readings; gives the statistics of the table.

    Stops if a column is missing, holds values of another type, or a key is NULL.
    """
    bad = conformance(df, TELEMETRY_SCHEMA).where("NOT conforms").select("column_name").collect()
    if bad:
        raise QualityGateError(f"columns do not conform: {[r.column_name for r in bad]}")
    typed = df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in TELEMETRY_SCHEMA})
    write_telemetry(with_ingestion_ts(typed, as_of), target, by)
    return ingest_stats(read_telemetry(df.sparkSession, target, None)).first().asDict()


def run_violations(
    spark: SparkSession, source: str, target: str, gc: GridCode = JOB
) -> int:
    """Write the readings that break a limit, and count what was written."""
    rows = read_telemetry(spark, source, None, only=beyond_limits(gc))
    write_violations(wide_violations(rows, gc), target)
    return violation_count(spark.read.parquet(target)).first()["violation_count"]
