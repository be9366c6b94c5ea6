"""Inverter efficiency and temperature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.config import LIMITS, PlantLimits
from fleetwatt.functions.scalars import count_rows, efficiency_band, pair_correlation
from fleetwatt.operators.compliance import BY_SYSTEM, grouped
from fleetwatt.operators.histograms import daily_histograms, summary_of_days
from fleetwatt.plans.joins import join_groups
from fleetwatt.plans.skew import exact_quantile

TEMP, EFF = "inverter_temp_c", "inverter_efficiency_pct"


def inverter_aggregates(limits: PlantLimits = LIMITS) -> dict[str, Column]:
    return {
        "n_readings": count_rows(),
        "mean_efficiency_pct": F.avg(EFF),
        "min_efficiency_pct": F.min(EFF),
        "max_temp_c": F.max(TEMP),
        "low_efficiency_count": F.count_if(F.col(EFF) < limits.inverter_efficiency_min_pct),
    }


def overtemp_aggregates(limits: PlantLimits = LIMITS) -> dict[str, Column]:
    hot = F.col(TEMP) > limits.inverter_temp_max_c
    summer = F.month("timestamp").isin(6, 7, 8, 9)
    return {
        "overtemp_events": F.count_if(hot),
        "overtemp_summer_events": F.count_if(hot & summer),
    }


def inverter_summary(df: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    return grouped(df, by, inverter_aggregates(limits)).withColumn(
        "efficiency_band", efficiency_band(F.col("mean_efficiency_pct"), limits)
    )


def inverter_status(mean: Column, limits: PlantLimits = LIMITS) -> Column:
    return F.when(mean > limits.inverter_efficiency_min_pct, "HEALTHY").otherwise("INVESTIGATE")


def temp_eff_corr(df: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    """Correlation of heat and efficiency; NULL if one of them never changes."""
    corr = F.col("temp_eff_corr")
    expected = corr < limits.temp_eff_corr_max
    return (
        df.groupBy(*by)
        .agg(
            pair_correlation(F.col(TEMP), F.col(EFF)).alias("temp_eff_corr"),
            F.max(TEMP).alias("max_temp_c"),
        )
        .withColumn(
            "corr_class",
            F.when(expected & (F.col("max_temp_c") > limits.inverter_temp_hot_c), "EXPECTED_HOT")
            .when(expected, "EXPECTED")
            .otherwise("WEAK"),
        )
    )


def thermal_summary(df: DataFrame, by=BY_SYSTEM, exact: bool = True) -> DataFrame:
    """Mean, 95th percentile and maximum temperature."""
    by = list(by)
    simple = {"n_readings": count_rows(), "mean_temp_c": F.avg(TEMP), "max_temp_c": F.max(TEMP)}
    if not exact:
        return grouped(df, by, {**simple, "p95_temp_c": F.percentile_approx(TEMP, 0.95)})
    p95 = exact_quantile(df, by, TEMP, 0.95, "p95_temp_c")
    return join_groups(grouped(df, by, simple), p95, by)


def temperature_histograms(df: DataFrame, keys=BY_SYSTEM) -> DataFrame:
    """The daily state from which thermal_of_days takes the summary of any period."""
    return daily_histograms(df, TEMP, keys)


def thermal_of_days(histograms: DataFrame, df: DataFrame, by=("system_id", "month")) -> DataFrame:
    """thermal_summary per group of days, from stored histograms and one pass over the readings."""
    names = {"mean": "mean_temp_c", "max": "max_temp_c", "quantile": "p95_temp_c"}
    return summary_of_days(histograms, df, TEMP, by, 0.95, names)


def overtemp(df: DataFrame, by=BY_SYSTEM, limits: PlantLimits = LIMITS) -> DataFrame:
    """Over-temperature events and how many of them fall in summer."""
    events, summer = F.col("overtemp_events"), F.col("overtemp_summer_events")
    return grouped(df, by, overtemp_aggregates(limits)).withColumn(
        "overtemp_class",
        F.when(summer > 0, "EXPECTED").when(events > 0, "INVESTIGATE").otherwise("WITHIN_LIMITS"),
    )


def overtemp_rows(df: DataFrame, limits: PlantLimits = LIMITS) -> DataFrame:
    return df.where(F.col(TEMP) > limits.inverter_temp_max_c)
