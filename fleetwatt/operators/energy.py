"""Energy totals, credits, net flow and the daily energy mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.config import LIMITS, PlantLimits
from fleetwatt.functions.scalars import count_rows, ratio, total
from fleetwatt.functions.wallclock import month_start
from fleetwatt.operators.compliance import BY_SYSTEM, grouped

_SUMS = {
    "solar_kwh": "solar_production_kw",
    "consumption_kwh": "consumption_kw",
    "grid_export_kwh": "grid_export_kw",
    "grid_import_kwh": "grid_import_kw",
}


def energy_aggregates(step_hours: float = 1.0) -> dict[str, Column]:
    """Power summed over readings, each standing for step_hours hours."""
    return {name: total(F.col(source)) * step_hours for name, source in _SUMS.items()}


def energy_columns(limits: PlantLimits = LIMITS) -> dict[str, Column]:
    export, solar = F.col("grid_export_kwh"), F.col("solar_kwh")
    return {
        "net_energy_kwh": export - F.col("grid_import_kwh"),
        "self_consumption_pct": (F.lit(1.0) - ratio(export, solar)) * 100.0,
        "export_credit_usd": export * limits.export_credit_usd_per_kwh,
    }


def energy_totals(
    df: DataFrame, by=BY_SYSTEM, step_hours: float = 1.0, limits: PlantLimits = LIMITS
) -> DataFrame:
    return grouped(df, by, energy_aggregates(step_hours)).withColumns(energy_columns(limits))


def net_flow(df: DataFrame) -> DataFrame:
    """Import and export from production and consumption."""
    surplus = F.col("solar_production_kw") - F.col("consumption_kw")
    return df.withColumns(
        {
            "grid_import_kw": F.greatest(F.lit(0.0), -surplus),
            "grid_export_kw": F.greatest(F.lit(0.0), surplus),
        }
    )


def utility_mode(df: DataFrame, by=(), default: str = "PGE") -> DataFrame:
    """Most frequent utility, the first in the alphabet on a tie.

    Counts per value come first, so no group is held in one buffer.
    """
    if "utility" not in df.columns:
        return df.groupBy(*by).agg(F.lit(default).alias("utility_mode"))
    rank = F.struct((-F.col("_n")).alias("n"), F.col("utility"))
    return (
        df.where(F.col("utility").isNotNull())
        .select(*by, F.col("utility"))
        .groupBy(*dict.fromkeys([*by, "utility"]))
        .agg(count_rows().alias("_n"))
        .groupBy(*by)
        .agg(F.min(rank)["utility"].alias("utility_mode"))
    )


def period_text(first: Column, last: Column) -> Column:
    return F.concat_ws(
        " to ",
        F.date_format(first, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(last, "yyyy-MM-dd HH:mm:ss"),
    )


def reporting_period(df: DataFrame, by=BY_SYSTEM) -> DataFrame:
    return (
        df.groupBy(*by)
        .agg(F.min("timestamp").alias("period_start"), F.max("timestamp").alias("period_end"))
        .withColumn("reporting_period", period_text(F.col("period_start"), F.col("period_end")))
    )


def energy_mart(df: DataFrame, step_hours: float = 1.0, limits: PlantLimits = LIMITS) -> DataFrame:
    """Energy per system and date."""
    keys = [c for c in ("utility", "system_id", "date") if c in df.columns]
    return grouped(df, keys, {"n_readings": count_rows(), **energy_aggregates(step_hours)}).withColumns(
        energy_columns(limits)
    )


def energy_rollup(mart: DataFrame, limits: PlantLimits = LIMITS) -> DataFrame:
    """Totals by utility and month, by utility, and over all.

    Summed to (utility, month) first: rollup copies its input once per level,
    and here only that short table is copied.
    """
    sums = ["n_readings", *_SUMS]
    monthly = (
        mart.withColumn("month", month_start(F.col("date")))
        .groupBy("utility", "month")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    return (
        monthly.rollup("utility", "month")
        .agg(F.grouping_id().cast("int").alias("level"), *[F.sum(c).alias(c) for c in sums])
        .withColumns(energy_columns(limits))
    )
