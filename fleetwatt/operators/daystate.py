"""Mergeable state of a system's day, and the battery tables and reports made from it.

One row per utility, system and date holds sums, extremes and the two ends of the day's state of
charge. Rows of any set of days merge: sums add, extremes compare, and the step between two days is
that from the last charge of one to the first of the next. So a run over a new day reads the
readings of that day only. A series of charge steps is that of a system.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from fleetwatt.config import ENGINE, LIMITS, GridCode, PlantLimits
from fleetwatt.functions.scalars import count_rows, ratio, round_trip_class, total
from fleetwatt.functions.wallclock import whole_days_between
from fleetwatt.operators.battery import health_columns
from fleetwatt.operators.compliance import BY_SYSTEM
from fleetwatt.operators.report import assemble, daily_sums, summed
from fleetwatt.operators.staging import with_month
from fleetwatt.schema import RAW_SCHEMA

KEYS = ["utility", "system_id", "date"]


def day_state(
    df: DataFrame, gc: GridCode = ENGINE, step_hours: float = 1.0, limits: PlantLimits = LIMITS
) -> DataFrame:
    """One row per utility, system and date of staged readings. All readings of a date must be there.

    Beside what the report adds up: the highest and lowest charge, the first and last one (with their
    times in period_start and period_end; NULL where that reading has none), and the sums of the
    steps up and down within the day.
    """
    columns = [c for c in RAW_SCHEMA.names if c in df.columns]
    rows = df if "utility" in df.columns else df.withColumn("utility", F.lit(None).cast("string"))
    soc = F.col("battery_soc_pct")
    inside = Window.partitionBy("system_id", "date").orderBy("timestamp")
    step = F.col("_step")
    more = [
        F.max(soc).alias("soc_max_pct"),
        F.min(soc).alias("soc_min_pct"),
        F.min_by(soc, "timestamp").alias("soc_first_pct"),
        F.max_by(soc, "timestamp").alias("soc_last_pct"),
        total(F.when(step > 0, step)).alias("charged_pct"),
        total(F.when(step < 0, -step)).alias("discharged_pct"),
    ]
    stepped = rows.withColumn("_step", soc - F.lag(soc).over(inside))
    return daily_sums(stepped, KEYS, columns, gc, limits, step_hours, more)


def _months(state: DataFrame, by) -> DataFrame:
    if "month" in by and "month" not in state.columns:
        return with_month(state.withColumn("timestamp", F.col("period_start"))).drop("timestamp")
    return state


_EXTREMES = ["soc_max_pct", "soc_min_pct", "soc_first_pct", "soc_last_pct"]
_ENDS = ["period_start", "period_end"]


def merge_days(state: DataFrame, by) -> DataFrame:
    """Rows of the state merged per group, system and date, as the report takes them."""
    sums = [c for c in state.columns if c not in (*by, *KEYS, *_EXTREMES, *_ENDS, "equivalent_cycles", "month")]
    swing = (F.max("soc_max_pct") - F.min("soc_min_pct")) / F.lit(100.0)
    return state.groupBy(*dict.fromkeys([*by, "system_id", "date"])).agg(
        F.min("period_start").alias("period_start"),
        F.max("period_end").alias("period_end"),
        F.coalesce(swing, F.lit(0.0)).alias("equivalent_cycles"),
        *[F.sum(c).alias(c) for c in sums],
    )


def battery_of(state: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    """State of health per group: the same columns and values as from the readings."""
    merged = summed(merge_days(_months(state, by), by), by)
    days = whole_days_between(F.col("period_start"), F.col("period_end"))
    summary = merged.select(*by, days.alias("days_in_service"), "equivalent_cycles")
    return summary.withColumns(health_columns(limits))


def fleet_of(state: DataFrame, limits: PlantLimits = LIMITS) -> DataFrame:
    """Systems per health class, lowest and mean state of health, by utility."""
    health = battery_of(state, ["utility", "system_id"], limits)
    of = lambda status: F.count_if(F.col("soh_status") == status)
    return health.groupBy("utility").agg(
        count_rows().alias("n_systems"),
        of("HEALTHY").alias("healthy"),
        of("WARNING").alias("warning"),
        of("CRITICAL").alias("critical"),
        F.min("soh_pct").alias("min_soh_pct"),
        F.avg("soh_pct").alias("mean_soh_pct"),
    )


def round_trip_of(state: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    """Discharge over charge per group, from the steps within days and between them.

    A window holds the days of one system, one row each.
    """
    rows = _months(state, by)
    keys = list(dict.fromkeys([*by, "system_id"]))
    days = rows.groupBy(*keys, "date").agg(
        F.min_by("soc_first_pct", "period_start").alias("_first"),
        F.max_by("soc_last_pct", "period_end").alias("_last"),
        F.sum("charged_pct").alias("_up"),
        F.sum("discharged_pct").alias("_down"),
    )
    between = F.col("_first") - F.lag("_last").over(Window.partitionBy(*keys).orderBy("date"))
    stepped = days.withColumn("_step", between)
    return (
        stepped.groupBy(*by)
        .agg(
            total(F.col("_up") + F.when(F.col("_step") > 0, F.col("_step")).otherwise(0.0)).alias("charged_pct"),
            total(F.col("_down") + F.when(F.col("_step") < 0, -F.col("_step")).otherwise(0.0)).alias("discharged_pct"),
        )
        .withColumn("round_trip_efficiency_pct", ratio(F.col("discharged_pct"), F.col("charged_pct")) * 100.0)
        .withColumn("rte_class", round_trip_class(F.col("round_trip_efficiency_pct"), limits))
    )


def _utility_of(state: DataFrame, by) -> DataFrame:
    """Most frequent utility of the readings, the first in the alphabet on a tie."""
    counted = state.where("utility IS NOT NULL").groupBy(*by, "utility").agg(F.sum("n_readings").alias("_n"))
    rank = F.struct((-F.col("_n")).alias("n"), F.col("utility"))
    return counted.groupBy(*by).agg(F.min(rank)["utility"].alias("utility_mode"))


def report_of(
    state: DataFrame, by=BY_SYSTEM, as_of: str | datetime | None = None, limits: PlantLimits = LIMITS
) -> DataFrame:
    """The monthly report per group, from the state of its days."""
    by, rows = list(by), _months(state, by)
    base = summed(merge_days(rows, by), by)
    rte = round_trip_of(rows, by, limits).select(*by, "round_trip_efficiency_pct")
    utility = None if "utility" in by else _utility_of(rows, by)
    return assemble(base, by, rte, utility, len(RAW_SCHEMA.names), as_of=as_of, limits=limits)
