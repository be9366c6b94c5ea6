"""Null-safe arithmetic and the classifications used in several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetwatt.config import LIMITS, PlantLimits


def null_if_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN sorts above every number in Spark, so it must not reach comparisons."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.expr(f"nanvl(`{c}`, CAST(NULL AS DOUBLE))") for c in present})


def ratio(num: Column, den: Column) -> Column:
    """Division that gives NULL on a zero divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def share_pct(part: Column, whole: Column) -> Column:
    return ratio(part * F.lit(100.0), whole)


def total(col: Column) -> Column:
    """Sum that is 0 over nothing."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def count_rows() -> Column:
    return F.count(F.lit(1))


def pair_correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs, NULL if one side is constant."""
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return ratio(F.covar_pop(x, y), F.stddev_pop(xs) * F.stddev_pop(ys))


def in_flex_window(ts: Column, limits: PlantLimits = LIMITS) -> Column:
    """Demand-response alert window; the last hour counts in full."""
    return F.hour(ts).between(limits.flex_first_hour, limits.flex_last_hour) & F.month(ts).between(
        limits.flex_first_month, limits.flex_last_month
    )


def soh_class(soh: Column, limits: PlantLimits = LIMITS) -> Column:
    return (
        F.when(soh >= limits.soh_warning_pct, "HEALTHY")
        .when(soh >= limits.soh_critical_pct, "WARNING")
        .when(soh.isNotNull(), "CRITICAL")
    )


def soh_action(soh: Column, limits: PlantLimits = LIMITS) -> Column:
    return (
        F.when(soh >= limits.soh_warning_pct, "Continue normal operation")
        .when(soh >= limits.soh_critical_pct, "Schedule service inspection within 6 months")
        .when(soh.isNotNull(), "Request warranty evaluation, replacement is likely")
    )


def efficiency_band(mean: Column, limits: PlantLimits = LIMITS) -> Column:
    return (
        F.when(mean >= limits.inverter_efficiency_excellent_pct, "EXCELLENT")
        .when(mean >= limits.inverter_efficiency_min_pct, "ACCEPTABLE")
        .when(mean.isNotNull(), "DEGRADED")
    )


def round_trip_class(rte: Column, limits: PlantLimits = LIMITS) -> Column:
    return (
        F.when(rte >= limits.rte_expected_pct, "EXPECTED")
        .when(rte >= limits.rte_low_pct, "LOW_END")
        .when(rte.isNotNull(), "BELOW_SPEC")
    )
