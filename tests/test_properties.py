"""Relations between operators that hold on any telemetry."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

from fleetwatt.config import ENGINE, MART
from fleetwatt.operators import compliance, demand_response, energy, merge, quality, series, staging
from fleetwatt.operators import violations as vio
from fleetwatt.operators.marts import compliance_extract
from fleetwatt.operators.report import flat, monthly_report
from fleetwatt.queries import telemetry
from tests.conftest import SF_DIR


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_one_pass_mart_equals_the_union(staged_rows):
    branches = [f(staged_rows, MART) for f in (vio.voltage_violations, vio.frequency_violations, vio.pf_violations)]
    union = reduce(lambda a, b: a.unionByName(b), branches)
    assert rows_of(vio.violation_rows(staged_rows, MART)) == rows_of(union)


def test_staging_is_idempotent(spark, staged_rows):
    again = staging.stage(staged_rows)
    assert rows_of(again) == rows_of(staged_rows.select(*again.columns))


def test_one_source_is_plain_staging(spark, staged_rows):
    one = staging.stage_sources({"only": telemetry(spark, SF_DIR)}).drop("n_sources", "best_source")
    assert rows_of(one) == rows_of(staged_rows.select(*one.columns))


def test_fleet_rate_is_the_weighted_mean(staged_rows):
    fleet = compliance.voltage_compliance(staged_rows, ENGINE, by=[]).first()
    parts = compliance.voltage_compliance(staged_rows, ENGINE).agg(
        F.sum("voltage_violations") * 100.0 / F.sum("n_readings")
    )
    assert fleet.voltage_violation_rate_pct == pytest.approx(parts.first()[0])


def test_daily_energy_adds_up(staged_rows):
    daily = energy.energy_mart(staged_rows)
    fleet = energy.energy_totals(staged_rows, by=[]).first()
    assert daily.agg(F.sum("solar_kwh")).first()[0] == pytest.approx(fleet.solar_kwh)
    whole = energy.energy_rollup(daily).where("level = 3").first()
    assert whole.grid_export_kwh == pytest.approx(fleet.grid_export_kwh)


def test_missing_and_present_make_the_grid(staged_rows):
    counts = series.missing_counts(staged_rows, "2024-06-01 00:00:00", "2024-06-30 23:00:00", 60, 50)
    assert counts.where("expected_readings <> 720").count() == 0
    listed = series.missing_readings(staged_rows, "2024-06-01 00:00:00", "2024-06-30 23:00:00", 60, 50)
    assert listed.count() == counts.agg(F.sum("missing_readings")).first()[0]


def test_completeness_bounds(spark):
    row = quality.cell_completeness(telemetry(spark, SF_DIR)).first()
    assert 0 <= row.completeness_pct <= 100


def test_extract_counts_equal_the_mart(staged_rows):
    extract = compliance_extract(staged_rows).groupBy("violation_type").agg(F.sum("violation_count").alias("n"))
    mart = vio.violation_rows(staged_rows).groupBy("violation_type").agg(F.count("*").alias("n"))
    assert rows_of(extract) == rows_of(mart)


def test_report_agrees_with_the_single_operators(staged_rows):
    report = flat(monthly_report(staged_rows, ENGINE, []), []).first()
    fleet = compliance.voltage_compliance(staged_rows, ENGINE, by=[]).first()
    assert report.voltage_range_a_compliance_pct == pytest.approx(fleet.voltage_compliance_pct)
    flex = compliance.flex_response(staged_rows, by=[]).first()
    assert report.load_reduction_achieved_pct == pytest.approx(flex.reduction_pct)
    totals = energy.energy_totals(staged_rows, by=[]).first()
    assert report.total_solar_generation_kwh == pytest.approx(totals.solar_kwh)
    assert report.utility_territory == "SDGE"


def test_report_takes_distortion_per_group(staged_rows):
    thd = staged_rows.select("system_id").distinct().select(
        "system_id", F.lit(2.5).alias("thd_voltage_pct"), F.lit(4.5).alias("thd_current_pct")
    )
    report = flat(monthly_report(staged_rows, ENGINE, ["system_id"], thd=thd), ["system_id"])
    assert report.select("thd_voltage_pct", "thd_current_pct").distinct().collect() == [(2.5, 4.5)]


def test_settlement_pays_the_reduction(staged_rows):
    paid = demand_response.dr_settlement(staged_rows)
    assert paid.where("settlement_usd < 0 OR settlement_usd <> reduced_kwh * 2.0").count() == 0


def test_merge_with_one_source_changes_nothing(staged_rows):
    rows = staged_rows.select("system_id", "timestamp", "voltage_v", "utility")
    merged = merge.merge_sources({"only": rows})
    assert rows_of(merged.drop("n_sources", "best_source")) == rows_of(rows)


def test_merge_prefers_the_first_value(spark):
    make = lambda v: spark.sql(
        f"SELECT 'A' AS system_id, TIMESTAMP_NTZ'2024-07-01 00:00:00' AS timestamp, CAST({v} AS DOUBLE) AS voltage_v"
    )
    merged = merge.merge_sources({"first": make("NULL"), "second": make("1.0"), "third": make("2.0")})
    row = merged.first()
    assert (row.voltage_v, row.n_sources, row.best_source) == (1.0, 3, "first")
