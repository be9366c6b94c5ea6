"""Telemetry tables in and out: Parquet, dated directories, JSON reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from fleetwatt.functions.scalars import null_if_nan
from fleetwatt.functions.wallclock import ntz
from fleetwatt.schema import MEASURES, RAW_SCHEMA


def read_telemetry(
    spark: SparkSession, path: str, schema: T.StructType | None = RAW_SCHEMA, only: Column | None = None
) -> DataFrame:
    """Scan a telemetry directory. A given schema skips footer inference.

    `only` is a condition on the stored columns. It reaches the scan, which a later condition on a
    measure does not, since NaN becomes NULL in between; NaN passes `>` and has to be met again later.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path)
    return null_if_nan(rows if only is None else rows.where(only), MEASURES)


def read_day(
    spark: SparkSession,
    root: str,
    day: str | date,
    schema: T.StructType | None = None,
    column: str = "dt",
) -> DataFrame:
    """One day of a dated layout. Only that day's directory is listed and read."""
    if schema is not None:
        schema = T.StructType([*schema.fields, T.StructField(column, T.DateType())])
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        rows = reader.option("basePath", root).parquet(f"{root.rstrip('/')}/{column}={day}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # A day without a directory has no rows; the layout gives the columns.
        rows = reader.parquet(root).where(F.col(column) == F.lit(str(day)).cast("date"))
    return null_if_nan(rows, MEASURES)


def with_ingestion_ts(df: DataFrame, as_of: str | datetime | None = None) -> DataFrame:
    stamp = F.localtimestamp() if as_of is None else ntz(as_of)
    return df.withColumn("ingestion_timestamp", stamp)


def write_by(
    df: DataFrame, path: str, by: str | list[str] = "date", mode: str = "overwrite"
) -> None:
    """Partitioned Parquet write that replaces only the partitions it holds.

    The rebalance hint gathers a partition value into few files, and lets
    adaptive execution split a value that is too large for one task.
    """
    by = [by] if isinstance(by, str) else by
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_telemetry(df: DataFrame, path: str, by: str = "date") -> None:
    """Write readings by date (or system). Adds the date when it is missing."""
    if by in ("date", "dt") and by not in df.columns:
        df = df.withColumn(by, F.to_date("timestamp"))
    write_by(df, path, by)


def write_violations(df: DataFrame, path: str, by: str | list[str] | None = None) -> None:
    if by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        write_by(df, path, by)


def write_report(df: DataFrame, path: str) -> None:
    """One JSON document per line and report row."""
    df.write.mode("overwrite").json(path)


def materialize(df: DataFrame, name: str, how: str = "view", path: str | None = None) -> DataFrame:
    """Register a model as a lazy view, or store it as a table, at a path if one is given."""
    if how == "view":
        df.createOrReplaceTempView(name)
    elif how == "table":
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        raise ValueError(f"unknown materialization: {how}")
    return df.sparkSession.table(name)
