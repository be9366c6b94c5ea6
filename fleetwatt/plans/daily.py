"""One day of the pipeline: gates, staging, marts, reports, table tests, alert count."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetwatt.config import DEFAULT_START, ENGINE, LIMITS, MART, PlantLimits
from fleetwatt.operators.daystate import battery_of, day_state, fleet_of, report_of
from fleetwatt.operators.energy import energy_mart
from fleetwatt.operators.inverter import temperature_histograms
from fleetwatt.operators.marts import compliance_extract
from fleetwatt.operators.quality import (
    QualityGateError,
    assert_gate,
    expectations,
    observe_gate,
    observed_gate,
    quality_gate,
)
from fleetwatt.operators.staging import dedup_latest, stage, stage_sources
from fleetwatt.operators.violations import critical_count, violations
from fleetwatt.plans.lineage import stored
from fleetwatt.schema import KEYS, RAW_SCHEMA
from fleetwatt.sources.readings import read_day, write_by, write_report


def _days(df: DataFrame, root: str, dates: list[str]) -> DataFrame | None:
    """The partitions of the given dates, None without a table; no other partition is read."""
    try:
        table = df.sparkSession.read.schema(df.schema).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table.where(F.col("date").isin([date.fromisoformat(d) for d in dates]))


def _staged_past_gate(raw: DataFrame, start, as_of, expected: int, limits: PlantLimits) -> tuple[DataFrame, dict]:
    """One source staged and stored, with the gate's facts taken on the way; a failed gate leaves scratch only."""
    rows, seen = observe_gate(raw, start, limits)
    new = stored(stage(rows, start), "new")
    return new, assert_gate(observed_gate(raw, new, seen.get, as_of, expected, limits))


def _gates(raw: dict[str, DataFrame], as_of, expected: int, limits: PlantLimits) -> dict:
    """The first source's record, with the invalid voltages of all sources."""
    records = [assert_gate(quality_gate(df, as_of, expected, limits)) for df in raw.values()]
    invalid = sum(r["invalid_voltage_records"] for r in records)
    return {**records[0], "invalid_voltage_records": invalid, "voltage_passed": invalid == 0}


def read_state(spark: SparkSession, target: str) -> DataFrame:
    """The state of all days that were run into a target."""
    return spark.read.parquet(f"{target}/state")


def run_day(
    spark: SparkSession,
    sources: str | dict[str, str],
    target: str,
    day: str,
    as_of: str | datetime,
    expected_systems: int = LIMITS.expected_systems,
    limits: PlantLimits = LIMITS,
    start: str | None = DEFAULT_START,
    step_hours: float | None = None,
) -> dict:
    """Read one day's directory of raw telemetry and bring every table up to it.

    sources is one dated directory, or several by name, the most trusted first; each must pass the
    gate. start is the table's first date. step_hours says how long a reading stands for; without
    it, the expected step of the limits.

    A reading may be late: it goes to the date it belongs to. The dates that the directory holds
    readings of are merged with what is staged there, the newest row of a key staying, and written
    anew; so two days in a row, or one day twice, give what all their readings give at once.
    Violations, energy, compliance and the state of those dates are written anew, too. Battery tables
    and reports are made from the state of all days, one row per system and date, and stored under
    the day; readings of other dates are not read.
    """
    roots = {"telemetry": sources} if isinstance(sources, str) else sources
    step = limits.expected_step_minutes / 60.0 if step_hours is None else step_hours
    raw = {name: read_day(spark, root, day, RAW_SCHEMA) for name, root in roots.items()}
    if len(raw) == 1:
        new, gate = _staged_past_gate(*raw.values(), start, as_of, expected_systems, limits)
    else:
        gate = _gates(raw, as_of, expected_systems, limits)
        new = stored(stage_sources(raw, start), "new")

    # A directory holds few dates: its own, and those of late readings.
    dates = [str(r["date"]) for r in new.select("date").distinct().collect()]
    before = _days(new, f"{target}/staging", dates)
    merged = new if before is None else stored(dedup_latest(before.select(new.columns).unionByName(new)), "merged")
    write_by(merged, f"{target}/staging", "date")
    # The same rows as those partitions, in few files: a table by date has at least one file per date.
    today = merged
    write_by(violations(today, MART, as_of), f"{target}/violations", "date")
    write_by(energy_mart(today, step, limits), f"{target}/energy", "date")
    write_by(compliance_extract(today, ENGINE, MART), f"{target}/compliance_extract", "date")

    write_by(temperature_histograms(today), f"{target}/temperature_histograms", "date")
    write_by(day_state(today, ENGINE, step, limits), f"{target}/state", "date")
    state = read_state(spark, target)
    dated = lambda df: df.withColumn("dt", F.lit(day).cast("date"))
    write_by(dated(battery_of(state, ["system_id"], limits)), f"{target}/battery", "dt")
    write_by(dated(fleet_of(state, limits)), f"{target}/battery_fleet", "dt")
    write_report(report_of(state, ["system_id"], as_of, limits), f"{target}/reports/dt={day}")

    failed = [r["expectation"] for r in expectations(today, KEYS, KEYS, {}, {}).where("NOT passed").collect()]
    if failed:
        raise QualityGateError(f"staged table fails {failed}")
    alerts = critical_count(violations(today, MART, as_of)).first()["critical_violations"]
    return {**gate, "critical_violations": alerts}


def run_days(spark: SparkSession, sources: str | dict[str, str], target: str, days: dict[str, str | datetime], **options) -> list[dict]:
    """Several days in order: each with its own time of reporting."""
    return [run_day(spark, sources, target, day, as_of, **options) for day, as_of in days.items()]
