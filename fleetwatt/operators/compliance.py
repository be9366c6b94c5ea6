"""Compliance rates per group. Every by=[] call covers the whole fleet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.config import ENGINE, LIMITS, GridCode, PlantLimits
from fleetwatt.functions.scalars import count_rows, in_flex_window, ratio, share_pct
from fleetwatt.operators.violations import (
    breaks,
    frequency_normal,
    frequency_trip,
    power_factor_low,
    voltage_normal,
    voltage_trip,
)

BY_SYSTEM = ("system_id",)

# Each function below comes as a set of named aggregates, so that one pass
# over the readings can serve several of them at once, and as an operator.


def voltage_aggregates(gc: GridCode = ENGINE) -> dict[str, Column]:
    return {
        "n_readings": count_rows(),
        "voltage_violations": F.count_if(breaks(voltage_normal(gc), gc)),
        "voltage_severe": F.count_if(voltage_trip(gc)),
    }


def frequency_aggregates(gc: GridCode = ENGINE) -> dict[str, Column]:
    return {
        "n_readings": count_rows(),
        "frequency_violations": F.count_if(breaks(frequency_normal(gc), gc)),
        "frequency_trips": F.count_if(frequency_trip(gc)),
    }


def pf_aggregates(gc: GridCode = ENGINE) -> dict[str, Column]:
    return {
        "n_readings": count_rows(),
        "pf_low": F.count_if(power_factor_low(gc)),
        "pf_mean": F.avg("power_factor"),
        "pf_min": F.min("power_factor"),
    }


def flex_aggregates(limits: PlantLimits = LIMITS) -> dict[str, Column]:
    inside = in_flex_window(F.col("timestamp"), limits)
    load = F.col("grid_import_kw")
    return {
        "n_readings": count_rows(),
        "flex_readings": F.count_if(inside),
        "baseline_import_kw": F.avg(F.when(~inside, load)),
        "flex_import_kw": F.avg(F.when(inside, load)),
    }


def grouped(df: DataFrame, by, aggregates: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[column.alias(name) for name, column in aggregates.items()])


def voltage_rate() -> Column:
    return share_pct(F.col("voltage_violations"), F.col("n_readings"))


def frequency_rate() -> Column:
    return share_pct(F.col("frequency_violations"), F.col("n_readings"))


def flex_reduction() -> Column:
    """Reduction in percent: 0 without a positive baseline, NULL without a window."""
    base, load = F.col("baseline_import_kw"), F.col("flex_import_kw")
    return F.when(
        F.col("flex_readings") > 0,
        F.when(base > 0, ratio(base - load, base) * 100.0).otherwise(F.lit(0.0)),
    )


def voltage_compliance(df: DataFrame, gc: GridCode = ENGINE, by=BY_SYSTEM) -> DataFrame:
    return grouped(df, by, voltage_aggregates(gc)).withColumns(
        {
            "voltage_violation_rate_pct": voltage_rate(),
            "voltage_compliance_pct": F.lit(100.0) - voltage_rate(),
        }
    )


def frequency_compliance(df: DataFrame, gc: GridCode = ENGINE, by=BY_SYSTEM) -> DataFrame:
    status = (
        F.when(F.col("frequency_trips") > 0, "TRIP_REQUIRED")
        .when(F.col("frequency_violations") > 0, "RIDE_THROUGH")
        .otherwise("STABLE")
    )
    return grouped(df, by, frequency_aggregates(gc)).withColumns(
        {
            "frequency_violation_rate_pct": frequency_rate(),
            "frequency_compliance_pct": F.lit(100.0) - frequency_rate(),
            "frequency_status": status,
        }
    )


def pf_summary(df: DataFrame, gc: GridCode = ENGINE, by=BY_SYSTEM) -> DataFrame:
    compliant = (F.lit(1.0) - ratio(F.col("pf_low"), F.col("n_readings"))) * 100.0
    return grouped(df, by, pf_aggregates(gc)).withColumn("pf_compliance_pct", compliant)


def flex_response(df: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    """Import inside and outside the alert window; groups without a window drop out."""
    return (
        grouped(df, by, flex_aggregates(limits))
        .where(F.col("flex_readings") > 0)
        .withColumn("reduction_pct", flex_reduction())
        .withColumn(
            "response_class",
            F.when(F.col("reduction_pct") > limits.flex_significant_pct, "SIGNIFICANT").otherwise(
                "LIMITED"
            ),
        )
    )


def status_of(rate: Column, limits: PlantLimits = LIMITS) -> Column:
    below = rate < limits.rule_violation_rate_max_pct
    return F.when(below, "COMPLIANT").otherwise("NON-COMPLIANT")


def rule_status(
    df: DataFrame, gc: GridCode = ENGINE, by=BY_SYSTEM, limits: PlantLimits = LIMITS
) -> DataFrame:
    rate = F.col("voltage_violation_rate_pct")
    return voltage_compliance(df, gc, by).select(
        *by, rate, status_of(rate, limits).alias("overall_status")
    )
