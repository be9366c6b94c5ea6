"""Limits, missing values, ties and empty groups, on literal readings."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetwatt.config import ENGINE, MART
from fleetwatt.functions import scalars
from fleetwatt.operators import battery, compliance, demand_response, energy, inverter, quality, series, staging
from fleetwatt.operators import violations as vio
from fleetwatt.operators.report import monthly_report
from tests.conftest import telemetry_rows

NOON = datetime(2024, 7, 1, 12)


def hourly(n, **columns):
    """n hourly readings; list values give one value per reading."""
    return [
        {
            "timestamp": NOON + timedelta(hours=i),
            **{c: v[i] if isinstance(v, list) else v for c, v in columns.items()},
        }
        for i in range(n)
    ]


def column(df, name):
    return [r[name] for r in df.orderBy("timestamp").collect()]


def test_voltage_limits_are_inclusive_and_trip_is_strict(spark):
    volts = [211.19, 211.2, 215.99, 216.0, 264.0, 264.01]
    df = telemetry_rows(spark, hourly(6, voltage_v=volts))
    assert column(vio.flag_voltage_normal(df), "voltage_normal") == [False] * 3 + [True, True, False]
    assert column(vio.flag_voltage_trip(df), "voltage_trip") == [True] + [False] * 5


def test_frequency_limits(spark):
    df = telemetry_rows(spark, hourly(6, frequency_hz=[56.99, 57.0, 59.3, 60.5, 61.2, 61.21]))
    assert column(vio.flag_frequency_normal(df), "frequency_normal") == [
        False, False, True, True, False, False,
    ]
    assert column(vio.flag_frequency_trip(df), "frequency_trip") == [True] + [False] * 4 + [True]


def test_power_factor_and_heat_limits(spark):
    df = telemetry_rows(
        spark, hourly(2, power_factor=[0.949, 0.95], solar_production_kw=1.0, inverter_temp_c=[65.0, 65.1])
    )
    assert compliance.pf_summary(df).first().pf_low == 1
    # The mart judges the power factor only above 1 kW of output.
    assert vio.pf_violations(df, MART).count() == 0
    assert vio.pf_violations(df.withColumn("solar_production_kw", F.lit(1.01)), MART).count() == 1
    assert inverter.overtemp(df).first().overtemp_events == 1


def test_severity_bounds(spark):
    volts = [240.0 * 1.08, 259.3, 264.0, 264.1]
    df = telemetry_rows(spark, hourly(4, voltage_v=volts))
    found = vio.voltage_violations(df).orderBy("timestamp").collect()
    assert [(r.measured_value, r.severity) for r in found] == [
        (259.3, "MODERATE"), (264.0, "MODERATE"), (264.1, "SEVERE"),
    ]


def test_missing_and_nan_readings(spark):
    nan = float("nan")
    rows = hourly(3, voltage_v=[None, nan, 240.0], frequency_hz=[nan, None, 60.0], power_factor=[nan, None, 0.9])
    df = scalars.null_if_nan(telemetry_rows(spark, rows), ["voltage_v", "frequency_hz", "power_factor"])
    # Missing counts against voltage and frequency in one profile, never for the power factor.
    assert compliance.voltage_compliance(df, ENGINE).first().voltage_violations == 2
    assert compliance.frequency_compliance(df, ENGINE).first().frequency_violations == 2
    assert compliance.pf_summary(df, ENGINE).first().pf_low == 1
    assert compliance.voltage_compliance(df, MART).first().voltage_violations == 0
    assert vio.violations(df, MART).count() == 0


def test_staging_turns_nan_into_null(spark):
    rows = hourly(1, voltage_v=float("nan"), ingestion_timestamp=NOON)
    row = staging.stage(telemetry_rows(spark, rows)).first()
    assert row.voltage_v is None and row.voltage_missing_flag == 1
    assert row.solar_negative_flag == 0


def test_dedup_takes_the_newest_and_breaks_ties(spark):
    late, early = datetime(2024, 7, 2), datetime(2024, 7, 1)
    rows = [
        {"timestamp": NOON, "ingestion_timestamp": late, "reading_id": 1},
        {"timestamp": NOON, "ingestion_timestamp": late, "reading_id": 2},
        {"timestamp": NOON, "ingestion_timestamp": early, "reading_id": 3},
    ]
    once = staging.dedup_latest(telemetry_rows(spark, rows))
    assert [r.reading_id for r in once.collect()] == [2]
    assert staging.dedup_latest(once).collect() == once.collect()


def test_keys_and_start(spark):
    rows = [
        {"timestamp": NOON, "system_id": None},
        {"timestamp": None},
        {"timestamp": datetime(2023, 12, 31, 23, 59)},
        {"timestamp": datetime(2024, 1, 1)},
    ]
    assert staging.clean_keys(telemetry_rows(spark, rows)).count() == 2
    assert staging.clean_keys(telemetry_rows(spark, rows), "2024-01-01 00:00:00").count() == 1


def test_settlement_counts_each_reading(spark):
    """A baseline of 4 kW: readings of 0 and 8 save 1 kWh in quarter hours, 0 and 2 save 1.5."""
    before = [{"timestamp": datetime(2024, 7, d, 17, m), "grid_import_kw": 4.0} for d in range(1, 11) for m in (0, 15)]
    for values, kwh in (((0.0, 8.0), 1.0), ((0.0, 2.0), 1.5)):
        day = [{"timestamp": datetime(2024, 7, 11, 17, 15 * i), "grid_import_kw": v} for i, v in enumerate([*values, None, None])]
        paid = demand_response.dr_settlement(telemetry_rows(spark, before + day), step_hours=0.25)
        assert paid.where("date = '2024-07-11'").first().reduced_kwh == kwh


def test_groups_without_a_utility_are_kept(spark):
    from pyspark.sql import functions as F

    rows = [{"timestamp": datetime(2024, 5, 1, h), "battery_soc_pct": 50.0 + (h % 3)} for h in range(12)]
    frame = telemetry_rows(spark, rows).withColumn("utility", F.lit(None).cast("string"))
    assert battery.round_trip_efficiency(frame, ["utility"]).first().charged_pct > 0


def test_a_missing_key_is_no_duplicate(spark):
    rows = [{"timestamp": NOON, "system_id": None}, {"timestamp": NOON, "system_id": None}, {"timestamp": NOON}, {"timestamp": NOON}]
    out = {r.expectation: r.failed_rows for r in quality.expectations(telemetry_rows(spark, rows), ["system_id"], ["system_id", "timestamp"], {}, {}).collect()}
    assert out == {"not_null_system_id": 2, "unique_system_id_timestamp": 1}


def test_flex_response_needs_a_window(spark):
    winter = [{"timestamp": datetime(2024, 1, 1, h), "grid_import_kw": 1.0} for h in range(24)]
    assert compliance.flex_response(telemetry_rows(spark, winter)).count() == 0


def test_flex_window_and_classes(spark):
    rows = [
        {"timestamp": datetime(2024, 6, 1, h), "grid_import_kw": 0.9 if 16 <= h <= 21 else 1.0}
        for h in range(24)
    ]
    row = compliance.flex_response(telemetry_rows(spark, rows)).first()
    assert row.flex_readings == 6
    assert row.reduction_pct == pytest.approx(10.0) and row.response_class == "LIMITED"
    none = compliance.flex_response(
        telemetry_rows(spark, [{**r, "grid_import_kw": 0.0} for r in rows])
    ).first()
    assert none.reduction_pct == 0.0


def test_zero_solar_gives_null_share(spark):
    df = telemetry_rows(spark, hourly(2, solar_production_kw=0.0, grid_export_kw=0.0))
    row = energy.energy_totals(df).first()
    assert row.self_consumption_pct is None and row.solar_kwh == 0.0
    empty = energy.energy_totals(telemetry_rows(spark, hourly(1))).first()
    assert empty.solar_kwh == 0.0 and empty.export_credit_usd == 0.0


def test_step_hours_scale_energy(spark):
    df = telemetry_rows(spark, hourly(12, solar_production_kw=6.0))
    assert energy.energy_totals(df, step_hours=1 / 12).first().solar_kwh == pytest.approx(6.0)


def test_constant_heat_has_no_correlation(spark):
    df = telemetry_rows(spark, hourly(3, inverter_temp_c=40.0, inverter_efficiency_pct=[96.0, 97.0, 98.0]))
    row = inverter.temp_eff_corr(df).first()
    assert row.temp_eff_corr is None and row.corr_class == "WEAK"


def test_days_are_whole_periods(spark):
    rows = [{"timestamp": datetime(2024, 7, 1, 20)}, {"timestamp": datetime(2024, 7, 2, 19)}]
    assert battery.days_in_service(telemetry_rows(spark, rows)).first().days_in_service == 0
    rows[1]["timestamp"] = datetime(2024, 7, 2, 20)
    assert battery.days_in_service(telemetry_rows(spark, rows)).first().days_in_service == 1


def test_days_ignore_clock_changes(spark):
    # 2024-03-10 has 23 hours in the session's zone.
    rows = [{"timestamp": datetime(2024, 3, 9, 12)}, {"timestamp": datetime(2024, 3, 10, 12)}]
    df = telemetry_rows(spark, rows)
    assert battery.days_in_service(df).first().days_in_service == 1
    assert series.gaps(df).first().gap_hours == 24.0


def test_single_reading(spark):
    df = telemetry_rows(spark, hourly(1, battery_soc_pct=50.0))
    assert battery.soc_events(df).count() == 0
    assert battery.daily_swing(df).first().swing_pct == 0.0
    rte = battery.round_trip_efficiency(df).first()
    assert rte.round_trip_efficiency_pct is None and rte.rte_class is None


def test_classes_at_their_limits(spark):
    values = spark.createDataFrame([(v,) for v in (85.0, 84.9, 70.0, 69.9)], "x double")
    classes = [r[0] for r in values.select(scalars.soh_class(F.col("x"))).collect()]
    assert classes == ["HEALTHY", "WARNING", "WARNING", "CRITICAL"]
    values = spark.createDataFrame([(v,) for v in (97.0, 96.0, 95.9)], "x double")
    bands = [r[0] for r in values.select(scalars.efficiency_band(F.col("x"))).collect()]
    assert bands == ["EXCELLENT", "ACCEPTABLE", "DEGRADED"]
    values = spark.createDataFrame([(v,) for v in (92.0, 90.0, 89.9)], "x double")
    assert [r[0] for r in values.select(scalars.round_trip_class(F.col("x"))).collect()] == [
        "EXPECTED", "LOW_END", "BELOW_SPEC",
    ]


def test_health_outlook_never_negative(spark):
    worn = spark.createDataFrame([(365 * 20, 5000.0)], "days_in_service int, equivalent_cycles double")
    row = worn.withColumns(battery.health_columns()).first()
    assert row.soh_pct == pytest.approx(47.5) and row.soh_status == "CRITICAL"
    assert row.eol_years == 0.0 and row.cycles_remaining == 0.0


def test_episodes_longer_than_the_limit(spark):
    def burst(start, minutes, volts):
        return [{"timestamp": start + timedelta(minutes=m), "voltage_v": volts} for m in minutes]

    rows = (
        burst(NOON, [0, 5], 200.0)
        + burst(NOON, [10], 240.0)
        + burst(NOON, [15, 20, 25], 200.0)
        + burst(NOON, [30], 240.0)
        + burst(NOON, [60], 200.0)
    )
    found = series.sustained_episodes(telemetry_rows(spark, rows)).collect()
    assert [(r.run_start, r.minutes, r.n_readings) for r in found] == [
        (NOON + timedelta(minutes=15), 10.0, 3)
    ]


def test_missing_slots(spark):
    day = datetime(2024, 7, 1)
    gone = {("A", 0), ("A", 100), ("B", 287)}
    rows = [
        {"system_id": s, "timestamp": day + timedelta(minutes=5 * i)}
        for s in "AB"
        for i in range(288)
        if (s, i) not in gone
    ]
    # A reading beside the grid fills no slot.
    rows.append({"system_id": "A", "timestamp": day + timedelta(minutes=501)})
    df = telemetry_rows(spark, rows)
    missing = series.missing_readings(df, day, day + timedelta(minutes=5 * 287))
    got = {(r.system_id, int((r.timestamp - day).total_seconds() // 300)) for r in missing.collect()}
    assert got == gone
    counts = series.missing_counts(df, day, day + timedelta(minutes=5 * 287), slots_per_block=100)
    assert {r.system_id: r.missing_readings for r in counts.collect()} == {"A": 2, "B": 1}


def test_gate_stops_on_stale_or_thin_data(spark):
    df = telemetry_rows(spark, hourly(2, voltage_v=[150.0, 240.0]))
    fresh = quality.quality_gate(df, NOON + timedelta(hours=2), expected=1)
    record = quality.assert_gate(fresh)
    assert record["invalid_voltage_records"] == 1 and record["gate_passed"]
    with pytest.raises(quality.QualityGateError):
        quality.assert_gate(quality.quality_gate(df, NOON + timedelta(hours=26), expected=1))
    with pytest.raises(quality.QualityGateError):
        quality.assert_gate(quality.quality_gate(df, NOON, expected=2))


def test_violation_log_defaults(spark):
    rows = hourly(7, voltage_v=[200.0, 215.0, None, 240.0, 270.0, 200.0, 200.0])
    log = vio.violation_log(telemetry_rows(spark, rows)).orderBy("position").collect()
    assert [r.value for r in log] == [200.0, 215.0, None, 270.0, 200.0]
    assert [r.severity for r in log] == ["CRITICAL", "MODERATE", "MODERATE", "MODERATE", "CRITICAL"]
    assert {r.utility for r in log} == {"Unknown"} and log[0].limit == "Range A: 216.0-264.0V"


def test_utility_mode_ties_and_default(spark):
    rows = hourly(4, utility=["SCE", "PGE", "SCE", "PGE"])
    df = telemetry_rows(spark, rows)
    assert energy.utility_mode(df).first().utility_mode == "PGE"
    assert energy.utility_mode(df.drop("utility")).first().utility_mode == "PGE"


def test_report_defaults_without_measurements(spark):
    rows = telemetry_rows(spark, hourly(1))
    kept = monthly_report(rows, by=["system_id"], as_of=NOON).first()
    assert kept.report_metadata.utility_territory is None  # a missing value is no default territory
    report = monthly_report(rows.drop("utility"), by=["system_id"], as_of=NOON).first()
    assert report.battery.round_trip_efficiency_pct == 93.0
    assert report.inverter.mean_efficiency_pct == 97.0
    assert report.compliance.thd_voltage_pct == 0.0
    assert report.report_metadata.utility_territory == "PGE"
    assert report.demand_response.flex_alert_participation == "N/A"
    assert report.compliance.overall_status == "NON-COMPLIANT"  # the voltage is missing
