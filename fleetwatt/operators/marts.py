"""Marts and fleet reports composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetwatt.config import ENGINE, LIMITS, MART, GridCode, PlantLimits
from fleetwatt.functions.scalars import count_rows, ratio
from fleetwatt.operators.battery import state_of_health
from fleetwatt.operators.compliance import (
    frequency_aggregates,
    frequency_rate,
    grouped,
    pf_aggregates,
    voltage_aggregates,
    voltage_rate,
)
from fleetwatt.operators.staging import with_month
from fleetwatt.operators.violations import power_factor_low


def battery_mart(df: DataFrame, limits: PlantLimits = LIMITS) -> DataFrame:
    """State of health per system and month."""
    return state_of_health(with_month(df), ["system_id", "month"], limits)


def compliance_extract(
    df: DataFrame, rates: GridCode = ENGINE, counts: GridCode = MART
) -> DataFrame:
    """Violation counts and compliance rates by utility, date and type.

    All counts and rates come from one aggregate, then turn into one row per
    type; the readings are read and shuffled once.
    """
    volts, hertz = F.col("voltage_v"), F.col("frequency_hz")
    kinds = {
        "VOLTAGE_LOW": volts < counts.voltage_min_v,
        "VOLTAGE_HIGH": volts > counts.voltage_max_v,
        "FREQUENCY_LOW": hertz < counts.frequency_min_hz,
        "FREQUENCY_HIGH": hertz > counts.frequency_max_hz,
        "POWER_FACTOR_LOW": power_factor_low(counts),
    }
    wide = grouped(
        df,
        ["utility", "date"],
        {
            **voltage_aggregates(rates),
            **frequency_aggregates(rates),
            **pf_aggregates(rates),
            **{kind: F.count_if(condition) for kind, condition in kinds.items()},
        },
    )
    pairs = F.array(
        *[
            F.struct(F.lit(kind).alias("violation_type"), F.col(kind).alias("violation_count"))
            for kind in kinds
        ]
    )
    pf_share = (F.lit(1.0) - ratio(F.col("pf_low"), F.col("n_readings"))) * 100.0
    return wide.select(
        "utility",
        "date",
        "n_readings",
        (F.lit(100.0) - voltage_rate()).alias("voltage_compliance_pct"),
        (F.lit(100.0) - frequency_rate()).alias("frequency_compliance_pct"),
        pf_share.alias("pf_compliance_pct"),
        F.inline(pairs),
    )


def soh_fleet(df: DataFrame, limits: PlantLimits = LIMITS) -> DataFrame:
    """Systems per health class, lowest and mean state of health, by utility."""
    health = state_of_health(df, ["utility", "system_id"], limits)
    of = lambda status: F.count_if(F.col("soh_status") == status)
    return health.groupBy("utility").agg(
        count_rows().alias("n_systems"),
        of("HEALTHY").alias("healthy"),
        of("WARNING").alias("warning"),
        of("CRITICAL").alias("critical"),
        F.min("soh_pct").alias("min_soh_pct"),
        F.avg("soh_pct").alias("mean_soh_pct"),
    )


def worst_batteries(df: DataFrame, k: int = 10, limits: PlantLimits = LIMITS) -> DataFrame:
    """The k systems with the lowest state of health."""
    health = state_of_health(df, ["system_id"], limits)
    return (
        health.select("system_id", "soh_pct", "soh_status", "equivalent_cycles", "days_in_service")
        .orderBy("soh_pct", "system_id")
        .limit(k)
    )
