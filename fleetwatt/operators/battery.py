"""Battery health, charge steps, round-trip efficiency, time of use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.config import LIMITS, PlantLimits
from fleetwatt.functions.scalars import ratio, round_trip_class, soh_action, soh_class, total
from fleetwatt.functions.wallclock import whole_days_between
from fleetwatt.operators.compliance import BY_SYSTEM
from fleetwatt.plans.chunks import with_previous


def daily_swing(df: DataFrame, by=BY_SYSTEM) -> DataFrame:
    """Highest minus lowest state of charge per group and date."""
    soc = F.col("battery_soc_pct")
    return (
        df.groupBy(*by, "date")
        .agg(F.max(soc).alias("soc_max_pct"), F.min(soc).alias("soc_min_pct"))
        .withColumn("swing_pct", F.col("soc_max_pct") - F.col("soc_min_pct"))
    )


def equivalent_cycles(df: DataFrame, by=BY_SYSTEM) -> DataFrame:
    cycles = total(F.col("swing_pct") / F.lit(100.0))
    return daily_swing(df, by).groupBy(*by).agg(cycles.alias("equivalent_cycles"))


def days_in_service(df: DataFrame, by=BY_SYSTEM) -> DataFrame:
    return df.groupBy(*by).agg(
        whole_days_between(F.min("timestamp"), F.max("timestamp")).alias("days_in_service")
    )


def service_summary(df: DataFrame, by=BY_SYSTEM) -> DataFrame:
    """Days and cycles together: a daily aggregate, then one over the days."""
    soc, ts = F.col("battery_soc_pct"), F.col("timestamp")
    daily = df.groupBy(*by, "date").agg(
        F.max(soc).alias("_high"),
        F.min(soc).alias("_low"),
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
    )
    return daily.groupBy(*by).agg(
        whole_days_between(F.min("_first"), F.max("_last")).alias("days_in_service"),
        total((F.col("_high") - F.col("_low")) / F.lit(100.0)).alias("equivalent_cycles"),
    )


def health_columns(limits: PlantLimits = LIMITS) -> dict[str, Column]:
    """Fade, state of health and its outlook from days and cycles."""
    years = F.col("days_in_service") / F.lit(365.0)
    cycles = F.col("equivalent_cycles")
    calendar_fade = years * limits.calendar_fade_pct_per_year
    cycle_fade = cycles / F.lit(limits.warranty_cycles) * limits.cycle_fade_pct
    soh = F.lit(100.0) - (calendar_fade + cycle_fade)
    margin = soh - limits.soh_critical_pct
    return {
        "soh_pct": soh,
        "soh_status": soh_class(soh, limits),
        "soh_action": soh_action(soh, limits),
        "eol_years": F.when(margin > 0, margin / F.lit(limits.calendar_fade_pct_per_year)).otherwise(
            F.lit(0.0)
        ),
        "cycles_remaining": F.greatest(F.lit(0.0), F.lit(limits.warranty_cycles) - cycles),
    }


def state_of_health(df: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    return service_summary(df, by).withColumns(health_columns(limits))


def fade_rate(df: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    """Fade scaled to one year, NULL before the first full day."""
    per_year = ratio((F.lit(100.0) - F.col("soh_pct")) * 365.0, F.col("days_in_service"))
    return (
        state_of_health(df, by, limits)
        .select(*by, "days_in_service", "soh_pct", per_year.alias("fade_pct_per_year"))
        .withColumn(
            "exceeds_limit", F.col("fade_pct_per_year") > limits.capacity_fade_max_pct_per_year
        )
    )


def _steps(df: DataFrame, by) -> DataFrame:
    """Change of the state of charge from the row before, within the group."""
    keys = list(dict.fromkeys([*by, "system_id"]))
    rows = df.select(*keys, "timestamp", "battery_soc_pct")
    return with_previous(rows, ["battery_soc_pct"], keys).withColumn(
        "soc_step_pct", F.col("battery_soc_pct") - F.col("previous_battery_soc_pct")
    )


def soc_events(df: DataFrame, by=BY_SYSTEM) -> DataFrame:
    """Charge and discharge events; the first row of a series has none."""
    step = F.col("soc_step_pct")
    kind = F.when(step > 0, "CHARGE").when(step < 0, "DISCHARGE")
    return _steps(df, by).withColumn("soc_event", kind).where("soc_event IS NOT NULL")


def round_trip_efficiency(df: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    """Discharge over charge, from steps of the state of charge.

    A proxy: the series may end at another charge than it began with, so the
    value can pass 100.
    """
    step = F.col("soc_step_pct")
    return (
        _steps(df, by)
        .groupBy(*by)
        .agg(
            total(F.when(step > 0, step)).alias("charged_pct"),
            total(F.when(step < 0, -step)).alias("discharged_pct"),
        )
        .withColumn(
            "round_trip_efficiency_pct", ratio(F.col("discharged_pct"), F.col("charged_pct")) * 100.0
        )
        .withColumn("rte_class", round_trip_class(F.col("round_trip_efficiency_pct"), limits))
    )


def tou_period(ts: Column) -> Column:
    """Off-peak 0-14 h, peak 16-20 h, the remaining hours other."""
    hour = F.hour(ts)
    return (
        F.when(hour.between(0, 14), "OFF_PEAK").when(hour.between(16, 20), "PEAK").otherwise("OTHER")
    )


def tou_split(df: DataFrame, by=(), limits: PlantLimits = LIMITS) -> DataFrame:
    """Charged and discharged energy by time-of-use period."""
    kwh = F.abs("soc_step_pct") / F.lit(100.0) * limits.battery_capacity_kwh
    step = F.col("soc_step_pct")
    return (
        _steps(df, by)
        .withColumn("period", tou_period(F.col("timestamp")))
        .groupBy(*by, "period")
        .agg(
            total(F.when(step > 0, kwh)).alias("charge_kwh"),
            total(F.when(step < 0, kwh)).alias("discharge_kwh"),
        )
    )
