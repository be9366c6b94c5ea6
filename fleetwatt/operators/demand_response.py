"""Demand-response baseline and settlement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetwatt.config import LIMITS, PlantLimits
from fleetwatt.functions.scalars import count_rows, ratio, total


def hourly_load(df: DataFrame) -> DataFrame:
    """Import per system, date and hour: sum, readings with a value, readings."""
    load = F.col("grid_import_kw")
    return df.groupBy("system_id", "date", F.hour("timestamp").alias("hour_of_day")).agg(
        F.sum(load).alias("_sum"), F.count(load).alias("_n"), count_rows().alias("n_readings")
    )


def dr_baseline(df: DataFrame, days: int = LIMITS.baseline_days) -> DataFrame:
    """Mean import in the same hour over the preceding days, against the day itself.

    The window runs over hourly sums: one row per day and hour, however many
    readings an hour has. NULL without a reading in the days before.
    """
    same_hour = (
        Window.partitionBy("system_id", "hour_of_day")
        .orderBy(F.unix_date("date"))
        .rangeBetween(-days, -1)
    )
    return (
        hourly_load(df)
        .withColumn(
            "baseline_kw", ratio(F.sum("_sum").over(same_hour), F.sum("_n").over(same_hour))
        )
        .withColumn("actual_kw", ratio(F.col("_sum"), F.col("_n")))
        .withColumn("reduction_kw", F.col("baseline_kw") - F.col("actual_kw"))
        .drop("_sum", "_n")
    )


def dr_settlement(
    df: DataFrame, step_hours: float = 1.0, limits: PlantLimits = LIMITS
) -> DataFrame:
    """Payment per system and day for import below the baseline in the alert window.

    Each reading with a value counts by itself: what another one draws above the baseline in the
    same hour is not set against it. The window is cut before the join, which keeps the hours'
    partitioning by system and hour.
    """
    in_window = F.col("hour_of_day").between(
        limits.flex_first_hour, limits.flex_last_hour
    ) & F.month("date").between(limits.flex_first_month, limits.flex_last_month)
    keys = ["system_id", "hour_of_day", "date"]
    base = dr_baseline(df, limits.baseline_days).where(in_window).select(*keys, "baseline_kw")
    readings = df.select(
        "system_id", F.hour("timestamp").alias("hour_of_day"), "date", "grid_import_kw"
    ).where(in_window)
    below = F.col("baseline_kw") - F.col("grid_import_kw")
    saved = F.when(below.isNotNull(), F.greatest(F.lit(0.0), below) * step_hours)
    return (
        readings.join(base, keys)
        .groupBy("system_id", "date")
        .agg(total(saved).alias("reduced_kwh"))
        .withColumn("settlement_usd", F.col("reduced_kwh") * limits.settlement_usd_per_kwh)
    )
