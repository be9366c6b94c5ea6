"""Limit flags per reading and the violation tables made from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwatt.config import ENGINE, JOB, LIMITS, MART, GridCode
from fleetwatt.functions.scalars import count_rows
from fleetwatt.functions.wallclock import month_start, ntz

# Texts of the violation tables.
VOLTAGE_REFERENCE = "CPUC Rule 21 Section 3.2.1"
FREQUENCY_REFERENCE = "IEEE 1547-2018 Table 7"
POWER_FACTOR_REFERENCE = "IEEE 1547-2018 Section 5.2"
VOLTAGE_ACTION = "Report to utility if sustained >5min per IEEE 1547"
FREQUENCY_ACTION = "Immediate disconnection if >0.5Hz per CAISO tariff"
POWER_FACTOR_ACTION = "Enable reactive power support per CPUC Rule 21"
LOG_TYPE = "VOLTAGE_DEVIATION_CPUC_RULE_21"
LOG_LIMIT = "Range A: %s-%sV"
LOG_TRIP_ACTION = "Trip inverter if Range B violated"
LOG_WATCH_ACTION = "Monitor and report to utility"

VIOLATION_COLUMNS = [
    "system_id",
    "date",
    "timestamp",
    "violation_type",
    "measured_value",
    "limit_min",
    "limit_max",
    "deviation",
    "severity",
    "regulatory_reference",
    "action_required",
    "analysis_timestamp",
]


# --- flags ------------------------------------------------------------------


def voltage_normal(gc: GridCode = ENGINE) -> Column:
    return F.col("voltage_v").between(gc.voltage_min_v, gc.voltage_max_v)


def voltage_trip(gc: GridCode = ENGINE) -> Column:
    """Must-trip check; there is no high side."""
    return F.col("voltage_v") < gc.voltage_trip_v


def frequency_normal(gc: GridCode = ENGINE) -> Column:
    return F.col("frequency_hz").between(gc.frequency_min_hz, gc.frequency_max_hz)


def frequency_trip(gc: GridCode = ENGINE) -> Column:
    hz = F.col("frequency_hz")
    return (hz > gc.frequency_trip_high_hz) | (hz < gc.frequency_trip_low_hz)


def power_factor_low(gc: GridCode = ENGINE) -> Column:
    low = F.col("power_factor") < gc.power_factor_min
    if gc.power_factor_min_solar_kw is None:
        return low
    return low & (F.col("solar_production_kw") > gc.power_factor_min_solar_kw)


def breaks(normal: Column, gc: GridCode) -> Column:
    """Is the reading outside its range? Missing counts only if the profile says so."""
    return ~F.coalesce(normal, F.lit(not gc.missing_is_violation))


def _with_flag(df: DataFrame, name: str, condition: Column) -> DataFrame:
    return df.withColumn(name, F.coalesce(condition, F.lit(False)))


def flag_voltage_normal(df: DataFrame, gc: GridCode = ENGINE) -> DataFrame:
    return _with_flag(df, "voltage_normal", voltage_normal(gc))


def flag_voltage_trip(df: DataFrame, gc: GridCode = ENGINE) -> DataFrame:
    return _with_flag(df, "voltage_trip", voltage_trip(gc))


def flag_frequency_normal(df: DataFrame, gc: GridCode = ENGINE) -> DataFrame:
    return _with_flag(df, "frequency_normal", frequency_normal(gc))


def flag_frequency_trip(df: DataFrame, gc: GridCode = ENGINE) -> DataFrame:
    return _with_flag(df, "frequency_trip", frequency_trip(gc))


def disconnects(df: DataFrame, limit_hz: float = LIMITS.disconnect_hz, gc: GridCode = MART) -> DataFrame:
    """Readings far enough off nominal frequency to require disconnection."""
    off = F.abs(F.col("frequency_hz") - gc.frequency_nominal_hz)
    return df.where(off > limit_hz).withColumn("frequency_off_hz", off)


# --- wide form --------------------------------------------------------------


def _outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def _wide_checks(gc: GridCode) -> tuple[Column, Column, Column]:
    voltage = _outside("voltage_v", gc.voltage_min_v, gc.voltage_max_v)
    frequency = _outside("frequency_hz", gc.frequency_min_hz, gc.frequency_max_hz)
    return voltage, frequency, power_factor_low(gc)


def beyond_limits(gc: GridCode = JOB) -> Column:
    """Does the reading break a limit? Plain comparisons of columns, which a Parquet scan can use.

    NaN is above every limit here. On columns of a file that may hold it, this keeps every violation
    and perhaps more; with NaN as NULL it keeps violations only.
    """
    voltage, frequency, low_pf = _wide_checks(gc)
    return voltage | frequency | low_pf


def wide_violations(df: DataFrame, gc: GridCode = JOB) -> DataFrame:
    """One nullable label per check; rows with at least one label."""
    voltage, frequency, low_pf = _wide_checks(gc)
    return df.where(beyond_limits(gc)).withColumns(
        {
            "voltage_violation": F.when(voltage, "VOLTAGE_DEVIATION"),
            "frequency_violation": F.when(frequency, "FREQUENCY_DEVIATION"),
            "power_factor_violation": F.when(low_pf, "POWER_FACTOR_LOW"),
        }
    )


def violation_count(wide: DataFrame) -> DataFrame:
    return wide.agg(count_rows().alias("violation_count"))


# --- long form --------------------------------------------------------------


def _sided(column: str, prefix: str, low: float, high: float) -> Column:
    value = F.col(column)
    return F.when(value < low, f"{prefix}_LOW").when(value > high, f"{prefix}_HIGH")


def _entry(kind, value, low, high, deviation, severity, reference) -> Column:
    return F.struct(
        kind.alias("violation_type"),
        value.alias("measured_value"),
        low.cast("double").alias("limit_min"),
        high.cast("double").alias("limit_max"),
        deviation.alias("deviation"),
        severity.alias("severity"),
        F.lit(reference).alias("regulatory_reference"),
    )


def _voltage_entry(gc: GridCode) -> tuple[Column, Column]:
    volts = F.col("voltage_v")
    off = F.abs(volts - gc.voltage_nominal_v) / F.lit(gc.voltage_nominal_v)
    kind = _sided("voltage_v", "VOLTAGE", gc.voltage_min_v, gc.voltage_max_v)
    severity = F.when(off > gc.voltage_severe_ratio, "SEVERE").when(
        off > gc.voltage_moderate_ratio, "MODERATE"
    )
    low, high = F.lit(gc.voltage_min_v), F.lit(gc.voltage_max_v)
    return kind, _entry(kind, volts, low, high, off * 100.0, severity, VOLTAGE_REFERENCE)


def _frequency_entry(gc: GridCode) -> tuple[Column, Column]:
    hz = F.col("frequency_hz")
    kind = _sided("frequency_hz", "FREQUENCY", gc.frequency_min_hz, gc.frequency_max_hz)
    low, high = F.lit(gc.frequency_min_hz), F.lit(gc.frequency_max_hz)
    off = F.abs(hz - gc.frequency_nominal_hz)
    return kind, _entry(kind, hz, low, high, off, F.lit("CRITICAL"), FREQUENCY_REFERENCE)


def _power_factor_entry(gc: GridCode) -> tuple[Column, Column]:
    pf = F.col("power_factor")
    kind = F.when(power_factor_low(gc), "POWER_FACTOR_LOW")
    low = F.lit(gc.power_factor_min)
    return kind, _entry(
        kind, pf, low, F.lit(None), low - pf, F.lit("MODERATE"), POWER_FACTOR_REFERENCE
    )


def _branch(df: DataFrame, kind: Column, entry: Column) -> DataFrame:
    return df.where(kind.isNotNull()).select("system_id", "date", "timestamp", entry.alias("_v")).select(
        "system_id", "date", "timestamp", "_v.*"
    )


def voltage_violations(df: DataFrame, gc: GridCode = MART) -> DataFrame:
    return _branch(df, *_voltage_entry(gc))


def frequency_violations(df: DataFrame, gc: GridCode = MART) -> DataFrame:
    return _branch(df, *_frequency_entry(gc))


def pf_violations(df: DataFrame, gc: GridCode = MART) -> DataFrame:
    return _branch(df, *_power_factor_entry(gc))


def action_required(kind: Column) -> Column:
    return (
        F.when(kind.startswith("VOLTAGE"), VOLTAGE_ACTION)
        .when(kind.startswith("FREQUENCY"), FREQUENCY_ACTION)
        .when(kind == "POWER_FACTOR_LOW", POWER_FACTOR_ACTION)
    )


def violation_rows(df: DataFrame, gc: GridCode = MART, keep: list[str] | None = None) -> DataFrame:
    """One row per violated check, in a single pass over the readings.

    Readings without a violation are filtered before the generator runs. Plain
    array and filter, so that all of it stays in one generated stage.
    """
    checks = [_voltage_entry(gc), _frequency_entry(gc), _power_factor_entry(gc)]
    kept = [*(keep or []), "system_id", "date", "timestamp"]
    entries = F.inline(F.array(*[entry for _, entry in checks]))
    return df.where(beyond_limits(gc)).select(*kept, entries).where(F.col("violation_type").isNotNull())


def violations(
    df: DataFrame,
    gc: GridCode = MART,
    as_of: str | datetime | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The violations mart: long rows with guidance and the time of analysis."""
    stamp = F.localtimestamp() if as_of is None else ntz(as_of)
    return (
        violation_rows(df, gc, keep)
        .withColumns(
            {
                "action_required": action_required(F.col("violation_type")),
                "analysis_timestamp": stamp,
            }
        )
        .select(*(keep or []), *VIOLATION_COLUMNS)
    )


def violation_log(
    df: DataFrame, gc: GridCode = ENGINE, k: int = 5, by: list[str] | None = None
) -> DataFrame:
    """The first k voltage violations in time order, per system by default."""
    by = ["system_id"] if by is None else by
    earliest = Window.partitionBy(*by).orderBy("timestamp", "system_id")
    trip = F.coalesce(voltage_trip(gc), F.lit(False))
    utility = F.col("utility") if "utility" in df.columns else F.lit(None).cast("string")
    return (
        df.where(breaks(voltage_normal(gc), gc))
        .select("system_id", "timestamp", "voltage_v", utility.alias("utility"))
        .withColumn("position", F.row_number().over(earliest))
        .where(F.col("position") <= k)
        .select(
            "system_id",
            "position",
            "timestamp",
            F.lit(LOG_TYPE).alias("type"),
            F.when(trip, "CRITICAL").otherwise("MODERATE").alias("severity"),
            F.col("voltage_v").alias("value"),
            F.lit(LOG_LIMIT % (gc.voltage_min_v, gc.voltage_max_v)).alias("limit"),
            F.coalesce("utility", F.lit("Unknown")).alias("utility"),
            F.when(trip, LOG_TRIP_ACTION).otherwise(LOG_WATCH_ACTION).alias("action"),
        )
    )


# --- questions put to the mart ---------------------------------------------


def violations_by_system(v: DataFrame, limit: int | None = None) -> DataFrame:
    """Violations per system, most first. With a limit no full sort is needed."""
    counted = v.groupBy("system_id").agg(count_rows().alias("violation_count"))
    ranked = counted.orderBy(F.desc("violation_count"), "system_id")
    return ranked if limit is None else ranked.limit(limit)


def frequent_violations(
    v: DataFrame, as_of: str | datetime | None = None, min_count: int = 10
) -> DataFrame:
    """Groups with more than min_count violations since the month began."""
    today = F.current_date() if as_of is None else F.to_date(ntz(as_of))
    return (
        v.where(F.col("date") >= month_start(today))
        .groupBy("system_id", "date", "violation_type")
        .agg(count_rows().alias("count"))
        .where(F.col("count") > min_count)
    )


def critical_count(v: DataFrame) -> DataFrame:
    return v.where(F.col("severity") == "CRITICAL").agg(count_rows().alias("critical_violations"))
