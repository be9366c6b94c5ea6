"""Streaming violation monitor: the batch checks on an unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetwatt.config import MART, GridCode
from fleetwatt.functions.scalars import count_rows, null_if_nan
from fleetwatt.operators.violations import violation_rows
from fleetwatt.schema import MEASURES


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    name_filter: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def violation_counts(
    telemetry: DataFrame,
    gc: GridCode = MART,
    watermark: str = "1 hour",
    window: str = "5 minutes",
    event_time: str = "event_time",
) -> DataFrame:
    """Violations per tumbling window, type and severity, on a stream or a table.

    event_time must be a zoned timestamp column, since watermarks need one.
    Repeats of a reading count once: on a table the one of smallest event_time, on a stream the
    first to arrive within the watermark, which is the same where events arrive in order.
    """
    rows = null_if_nan(telemetry, MEASURES).where(
        F.col("system_id").isNotNull() & F.col(event_time).isNotNull()
    )
    keys = ["system_id", "timestamp"]
    if telemetry.isStreaming:
        rows = rows.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)
    else:
        order = Window.partitionBy(*keys).orderBy(event_time, *[c for c in ("reading_id",) if c in rows.columns])
        rows = rows.withColumn("_copy", F.row_number().over(order)).where("_copy = 1").drop("_copy")
    found = violation_rows(rows.withColumn("date", F.to_date("timestamp")), gc, keep=[event_time])
    return (
        found.groupBy(F.window(event_time, window).alias("_w"), "violation_type", "severity")
        .agg(count_rows().alias("violation_count"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "violation_type",
            "severity",
            "violation_count",
        )
    )


def start_monitor(
    counts: DataFrame, output: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append closed windows to a Parquet table; restarts from its checkpoint."""
    writer = (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_latest(counts: DataFrame, output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the windows that each batch changes, open ones too; latest_counts gives their state.

    A batch has a folder of its own, so one that is run again replaces what it wrote.
    """

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    writer = counts.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_counts(spark: SparkSession, output: str, schema: T.StructType) -> DataFrame:
    """The last count of every window: after the stream's end, the counts of the whole table."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(output)
    keys = ["window_start", "window_end", "violation_type", "severity"]
    return rows.groupBy(*keys).agg(F.max_by("violation_count", "batch").alias("violation_count"))
