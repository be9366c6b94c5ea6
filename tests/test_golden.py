"""Counts that the mapped telemetry is known to have at the smallest scale."""

import pytest
from pyspark.sql import functions as F

from fleetwatt.config import DEFAULT_START, ENGINE, JOB
from fleetwatt.operators import battery, compliance, demand_response, inverter, series, violations
from fleetwatt.plans.lineage import stored
from fleetwatt.queries import staged, telemetry
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def staged_rows(spark):
    """Staged telemetry since the first date of the staging model."""
    return stored(staged(spark, SF_DIR, DEFAULT_START), "golden")


def test_raw_and_staged_rows(spark, staged_rows):
    raw = telemetry(spark, SF_DIR)
    assert raw.count() == 1000
    assert raw.where("system_id IS NOT NULL").count() == 995
    assert staged_rows.count() == 905
    flags = staged_rows.agg(
        F.sum("voltage_missing_flag"), F.sum("frequency_missing_flag"), F.sum("solar_negative_flag")
    ).first()
    assert tuple(flags) == (7, 9, 9)


def test_violations(staged_rows):
    counts = {
        (r.violation_type, r.severity): r["count"]
        for r in violations.violations(staged_rows).groupBy("violation_type", "severity").count().collect()
    }
    assert counts == {
        ("FREQUENCY_HIGH", "CRITICAL"): 128,
        ("FREQUENCY_LOW", "CRITICAL"): 127,
        ("POWER_FACTOR_LOW", "MODERATE"): 33,
        ("VOLTAGE_HIGH", "MODERATE"): 31,
        ("VOLTAGE_HIGH", "SEVERE"): 49,
        ("VOLTAGE_LOW", "MODERATE"): 24,
        ("VOLTAGE_LOW", "SEVERE"): 40,
    }
    assert violations.wide_violations(staged_rows, JOB).count() == 408


def test_engine_profile_counts_missing_readings(staged_rows):
    row = compliance.voltage_compliance(staged_rows, ENGINE, by=[]).first()
    assert (row.voltage_violations, row.voltage_severe) == (89 + 7, 12)
    row = compliance.frequency_compliance(staged_rows, ENGINE, by=[]).first()
    assert (row.frequency_violations, row.frequency_trips) == (89 + 9, 3)


def test_battery_and_inverter(staged_rows):
    events = {r.soc_event: r["count"] for r in battery.soc_events(staged_rows).groupBy("soc_event").count().collect()}
    assert events == {"CHARGE": 437, "DISCHARGE": 453}
    assert battery.daily_swing(staged_rows).count() == 380
    cycles = battery.equivalent_cycles(staged_rows).agg(F.sum("equivalent_cycles")).first()[0]
    assert round(cycles, 2) == 102.83
    row = inverter.thermal_summary(staged_rows, by=[]).first()
    assert (round(row.max_temp_c, 6), round(row.p95_temp_c, 6)) == (78.694125, 56.53075)
    assert round(inverter.temp_eff_corr(staged_rows, by=[]).first().temp_eff_corr, 6) == -0.454517
    assert inverter.overtemp(staged_rows, by=[]).first().overtemp_events == 7


def test_series(staged_rows):
    assert series.gaps(staged_rows).count() == 738
    missing = series.missing_readings(
        staged_rows, "2024-06-01 00:00:00", "2024-06-30 23:00:00", 60, 24
    )
    assert missing.count() == 10744
    base = demand_response.dr_baseline(staged_rows)
    row = base.agg(F.count("baseline_kw"), F.sum("baseline_kw")).first()
    assert (row[0], round(row[1], 6)) == (441, 423.005083)


def test_time_of_use(staged_rows):
    split = {r.period: (r.charge_kwh, r.discharge_kwh) for r in battery.tou_split(staged_rows).collect()}
    assert {p: (round(a, 2), round(b, 2)) for p, (a, b) in split.items()} == {
        "OFF_PEAK": (1021.68, 996.03),
        "PEAK": (396.09, 365.85),
        "OTHER": (231.93, 281.07),
    }
