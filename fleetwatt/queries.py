"""Registered queries: one per operator, over telemetry derived from events.

Each takes (spark, sf_dir) and reads whole tables. Computed doubles are rounded,
since the order of a sum is not fixed in a distributed plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from fleetwatt.config import DEFAULT_START, ENGINE, JOB, LIMITS, MART
from fleetwatt.functions.scalars import in_flex_window, ratio
from fleetwatt.operators import (
    battery,
    compliance,
    daystate,
    demand_response,
    energy,
    harmonics,
    inverter,
    marts,
    merge,
    outliers,
    quality,
    report,
    series,
    staging,
    violations as vio,
)
from fleetwatt.plans.daily import read_state, run_days as run_all_days
from fleetwatt.plans.lineage import scratch_path, stored
from fleetwatt.schema import KEYS, MEASURES, RAW_SCHEMA, TELEMETRY_SCHEMA
from fleetwatt.sources import readings
from fleetwatt.sources.events import map_events, telemetry_from_events
from fleetwatt.streaming import episodes, monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The clock of the checked queries.
AS_OF = "2024-12-16 00:00:00"
AS_OF_MONTH = "2024-06-15 00:00:00"
DAY = "2024-06-15"
EXPECTED_SYSTEMS = 150
ID = ["system_id"]
ROW = ["system_id", "timestamp"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sums of readings end at the fifth decimal and credits at the eighth. Means and
# shares get more places, so that no exact value ends in a tie.
_SIX = ["temp_eff_corr", "fundamental", "thd_pct", "thd_voltage_pct", "thd_current_pct"]
_SIX += ["solar_kwh", "consumption_kwh", "grid_export_kwh", "grid_import_kwh", "net_energy_kwh"]
_SIX += ["total_solar_generation_kwh", "total_consumption_kwh", "total_grid_export_kwh"]
_SIX += ["total_grid_import_kwh", "charge_kwh", "discharge_kwh"]
DIGITS = {**dict.fromkeys(_SIX, 6), "export_credit_usd": 8, "utility_credits_estimated_usd": 8}


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS.get(c, 9)) for c in columns})


def steady(df: DataFrame, **means: Column) -> DataFrame:
    """Means over n complete readings, made again from the rounded sum.

    The sums are exact at six places, the means of 16 readings are not at any
    sensible number of places.
    """
    again = {c: ratio(F.round(F.col(c) * n, 6), n) for c, n in means.items()}
    return df.withColumns(again)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(spark, sf_dir)


def staged(spark: SparkSession, sf_dir: str, start: str | None = None) -> DataFrame:
    """The staging model over all readings; only the queries about a first date give one."""
    return staging.stage(telemetry(spark, sf_dir), start)


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vio.violations(staged(spark, sf_dir), MART, AS_OF)


# --- sources, sinks, schema --------------------------------------------------


@query
def a01_typed_scan(spark, sf_dir):
    path = scratch_path(spark, "typed")
    telemetry(spark, sf_dir).write.parquet(path)
    return readings.read_telemetry(spark, path, TELEMETRY_SCHEMA)


@query
def a02_scan(spark, sf_dir):
    path = scratch_path(spark, "scan")
    telemetry(spark, sf_dir).write.parquet(path)
    return readings.read_telemetry(spark, path, None)


@query
def a03_day_slice(spark, sf_dir):
    path = scratch_path(spark, "days")
    rows = telemetry(spark, sf_dir).withColumn("dt", F.to_date("timestamp"))
    readings.write_by(rows, path, "dt")
    return readings.read_day(spark, path, DAY, RAW_SCHEMA)


@query
def a04_conformance(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    number = F.col("reading_id")
    spoiled = {c: F.col(c).cast("string") for c in TELEMETRY_SCHEMA.names}
    spoiled["voltage_v"] = F.when(number % 89 == 0, "broken").otherwise(spoiled["voltage_v"])
    spoiled["frequency_hz"] = F.when(number % 83 == 0, "n/a").otherwise(spoiled["frequency_hz"])
    spoiled["timestamp"] = F.when(number % 79 == 0, "yesterday").otherwise(spoiled["timestamp"])
    text = rows.select(*[c.alias(n) for n, c in spoiled.items() if n != "battery_power_kw"])
    return quality.conformance(text)


@query
def a05_ingest_stamp(spark, sf_dir):
    return readings.with_ingestion_ts(telemetry(spark, sf_dir), AS_OF)


@query
def a06_write_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "telemetry")
    readings.write_telemetry(telemetry(spark, sf_dir), path, by="date")
    return readings.read_telemetry(spark, path, None)


@query
def a07_violations_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "violations")
    readings.write_violations(mart(spark, sf_dir), path)
    return rounded(spark.read.parquet(path), "deviation")


@query
def a08_ingest_stats(spark, sf_dir):
    return quality.ingest_stats(telemetry(spark, sf_dir), digits=(9, 9, 9))


@query
def a09_report_roundtrip(spark, sf_dir):
    path, by = scratch_path(spark, "report"), ["system_id", "month"]
    made = report.monthly_report(staged(spark, sf_dir), ENGINE, by, as_of=AS_OF)
    readings.write_report(made, path)
    return _rounded_report(report.flat(spark.read.schema(made.schema).json(path), by))


@query
def a10_named_models(spark, sf_dir):
    """The staging model as a view, and a question put to it by name."""
    readings.materialize(staged(spark, sf_dir), "stg_telemetry", "view")
    return spark.sql(
        "SELECT utility, hour_of_day, count(*) AS n_readings FROM stg_telemetry GROUP BY ALL"
    )


@query
def a11_materialized_mart(spark, sf_dir):
    """The mart stored as a table, and a question put to it by name."""
    path = scratch_path(spark, "mart")
    readings.materialize(mart(spark, sf_dir), "grid_compliance_violations", "table", path)
    return spark.sql(
        "SELECT violation_type, severity, count(*) AS violation_count "
        "FROM grid_compliance_violations GROUP BY ALL"
    )


# --- staging and flags -------------------------------------------------------


@query
def b01_project(spark, sf_dir):
    return staging.project_raw(telemetry(spark, sf_dir))


@query
def b02_clean_keys(spark, sf_dir):
    return staging.clean_keys(telemetry(spark, sf_dir), DEFAULT_START).select("reading_id", *ROW)


@query
def b03_dedup_latest(spark, sf_dir):
    rows = staging.clean_keys(telemetry(spark, sf_dir), DEFAULT_START)
    return staging.dedup_latest(rows).select("reading_id", *ROW, "ingestion_timestamp")


@query
def b04_calendar(spark, sf_dir):
    rows = staging.with_calendar(telemetry(spark, sf_dir))
    return rows.select("reading_id", "timestamp", "date", "hour_of_day")


@query
def b05_self_consumption(spark, sf_dir):
    rows = staging.self_consumption(telemetry(spark, sf_dir))
    return rounded(rows.select("reading_id", "self_consumption_rate_pct"), "self_consumption_rate_pct")


@query
def b06_quality_flags(spark, sf_dir):
    rows = staging.quality_flags(telemetry(spark, sf_dir))
    flags = ["voltage_missing_flag", "frequency_missing_flag", "solar_negative_flag"]
    return rows.select("reading_id", *flags)


@query
def b07_staging(spark, sf_dir):
    return rounded(staged(spark, sf_dir, DEFAULT_START), "self_consumption_rate_pct")


@query
def b08_voltage_range_flag(spark, sf_dir):
    rows = vio.flag_voltage_normal(staged(spark, sf_dir))
    return rows.select(*ROW, "voltage_v", "voltage_normal")


@query
def b09_voltage_trip_flag(spark, sf_dir):
    rows = vio.flag_voltage_trip(staged(spark, sf_dir))
    return rows.select(*ROW, "voltage_v", "voltage_trip")


@query
def b10_frequency_range_flag(spark, sf_dir):
    rows = vio.flag_frequency_normal(staged(spark, sf_dir))
    return rows.select(*ROW, "frequency_hz", "frequency_normal")


@query
def b11_frequency_trip_flag(spark, sf_dir):
    rows = vio.flag_frequency_trip(staged(spark, sf_dir))
    return rows.select(*ROW, "frequency_hz", "frequency_trip")


@query
def b12_wide_violations(spark, sf_dir):
    labels = ["voltage_violation", "frequency_violation", "power_factor_violation"]
    return vio.wide_violations(telemetry(spark, sf_dir), JOB).select(*ROW, *labels)


@query
def b13_voltage_violations(spark, sf_dir):
    return rounded(vio.voltage_violations(staged(spark, sf_dir)), "deviation")


@query
def b14_frequency_violations(spark, sf_dir):
    return rounded(vio.frequency_violations(staged(spark, sf_dir)), "deviation")


@query
def b15_pf_violations(spark, sf_dir):
    return rounded(vio.pf_violations(staged(spark, sf_dir)), "deviation")


@query
def b16_violations_mart(spark, sf_dir):
    return rounded(mart(spark, sf_dir).drop("analysis_timestamp"), "deviation")


@query
def b17_action_required(spark, sf_dir):
    found = vio.violation_rows(staged(spark, sf_dir))
    return found.select(
        *ROW, "violation_type", vio.action_required(F.col("violation_type")).alias("action_required")
    )


@query
def b18_analysis_stamp(spark, sf_dir):
    return mart(spark, sf_dir).select(*ROW, "violation_type", "analysis_timestamp")


@query
def b19_violation_log(spark, sf_dir):
    return vio.violation_log(staged(spark, sf_dir))


@query
def b20_flex_window(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return rows.select(*ROW, in_flex_window(F.col("timestamp")).alias("in_flex_window"))


# --- compliance --------------------------------------------------------------

_VOLTAGE_PCT = ["voltage_violation_rate_pct", "voltage_compliance_pct"]
_FREQUENCY_PCT = ["frequency_violation_rate_pct", "frequency_compliance_pct"]


@query
def c01_voltage_rate(spark, sf_dir):
    rates = compliance.voltage_compliance(staged(spark, sf_dir)).drop("voltage_severe")
    return rounded(rates, *_VOLTAGE_PCT)


@query
def c01_voltage_rate_fleet(spark, sf_dir):
    return rounded(compliance.voltage_compliance(staged(spark, sf_dir), by=[]), *_VOLTAGE_PCT)


@query
def c02_voltage_severe(spark, sf_dir):
    return compliance.voltage_compliance(staged(spark, sf_dir)).select("system_id", "voltage_severe")


@query
def c03_frequency_rate(spark, sf_dir):
    return rounded(compliance.frequency_compliance(staged(spark, sf_dir)), *_FREQUENCY_PCT)


@query
def c04_pf_summary(spark, sf_dir):
    return rounded(compliance.pf_summary(staged(spark, sf_dir)), "pf_mean", "pf_compliance_pct")


def _captures(spark, sf_dir):
    """Stored captures of 64 samples: even vectors are voltages, the next odd ones currents."""
    stored = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    kind = F.when(F.col("vec_id") % 2 == 0, "voltage").otherwise("current")
    capture = F.expr("vec_id div 2").alias("capture_id")
    waves = stored.select(capture, kind.alias("kind"), F.posexplode("embedding").alias("n", "value"))
    return harmonics.thd(waves, ["capture_id", "kind"], samples=64, harmonics=31)


@query
def c05_thd_check(spark, sf_dir):
    checked = harmonics.thd_check(_captures(spark, sf_dir), ["capture_id"])
    return rounded(checked, "thd_voltage_pct", "thd_current_pct")


def _flex(spark, sf_dir, by):
    flex = rounded(compliance.flex_response(staged(spark, sf_dir), by), "reduction_pct")
    inside, rows = F.col("flex_readings"), F.col("n_readings")
    return steady(flex, flex_import_kw=inside, baseline_import_kw=rows - inside)


@query
def c06_flex_response(spark, sf_dir):
    return _flex(spark, sf_dir, ID).drop("response_class")


@query
def c06_flex_response_fleet(spark, sf_dir):
    return _flex(spark, sf_dir, [])


@query
def c07_flex_class(spark, sf_dir):
    return compliance.flex_response(staged(spark, sf_dir)).select("system_id", "response_class")


@query
def c08_rule_status(spark, sf_dir):
    return rounded(compliance.rule_status(staged(spark, sf_dir)), "voltage_violation_rate_pct")


@query
def c09_by_system(spark, sf_dir):
    return vio.violations_by_system(mart(spark, sf_dir))


@query
def c10_frequent_violations(spark, sf_dir):
    return vio.frequent_violations(mart(spark, sf_dir), AS_OF_MONTH, min_count=1)


@query
def c11_critical_count(spark, sf_dir):
    return vio.critical_count(mart(spark, sf_dir))


@query
def c12_job_violation_count(spark, sf_dir):
    return vio.violation_count(vio.wide_violations(telemetry(spark, sf_dir), JOB))


# --- battery and inverter ----------------------------------------------------


@query
def d01_daily_swing(spark, sf_dir):
    return battery.daily_swing(staged(spark, sf_dir))


@query
def d02_equiv_cycles(spark, sf_dir):
    return rounded(battery.equivalent_cycles(staged(spark, sf_dir)), "equivalent_cycles")


@query
def d03_days_in_service(spark, sf_dir):
    return battery.days_in_service(staged(spark, sf_dir))


_HEALTH = ["equivalent_cycles", "soh_pct", "eol_years", "cycles_remaining"]


@query
def d04_soh(spark, sf_dir):
    health = battery.state_of_health(staged(spark, sf_dir))
    names = ["system_id", "days_in_service", "equivalent_cycles", "soh_pct"]
    return rounded(health.select(*names), "equivalent_cycles", "soh_pct")


@query
def d05_soh_class(spark, sf_dir):
    return battery.state_of_health(staged(spark, sf_dir)).select("system_id", "soh_status", "soh_action")


@query
def d06_eol_years(spark, sf_dir):
    return rounded(battery.state_of_health(staged(spark, sf_dir)).select("system_id", "eol_years"), "eol_years")


@query
def d07_cycles_left(spark, sf_dir):
    health = battery.state_of_health(staged(spark, sf_dir))
    return rounded(health.select("system_id", "cycles_remaining"), "cycles_remaining")


@query
def d08_soc_events(spark, sf_dir):
    return battery.soc_events(staged(spark, sf_dir))


@query
def d09_rte_class(spark, sf_dir):
    return battery.round_trip_efficiency(staged(spark, sf_dir)).select("system_id", "rte_class")


_MEAN_EFF = "mean_efficiency_pct"


@query
def d10_inverter_summary(spark, sf_dir):
    means = inverter.inverter_summary(staged(spark, sf_dir)).drop("efficiency_band")
    return steady(means, mean_efficiency_pct=F.col("n_readings"))


@query
def d11_efficiency_band(spark, sf_dir):
    return inverter.inverter_summary(staged(spark, sf_dir)).select("system_id", "efficiency_band")


@query
def d12_temp_eff_corr(spark, sf_dir):
    return rounded(inverter.temp_eff_corr(staged(spark, sf_dir)), "temp_eff_corr")


def _thermal(spark, sf_dir, by):
    heat = inverter.thermal_summary(staged(spark, sf_dir), by)
    return steady(rounded(heat, "p95_temp_c"), mean_temp_c=F.col("n_readings"))


@query
def d13_thermal_summary(spark, sf_dir):
    return _thermal(spark, sf_dir, ID)


@query
def d13_thermal_monthly(spark, sf_dir):
    """From daily histograms and one pass over the readings of the bins with the rank."""
    rows = stored(staged(spark, sf_dir).select("system_id", "date", inverter.TEMP), "staged")
    histograms = stored(inverter.temperature_histograms(rows), "histograms")
    heat = inverter.thermal_of_days(histograms, rows)
    return steady(rounded(heat, "p95_temp_c"), mean_temp_c=F.col("n_readings"))


@query
def d13_thermal_summary_fleet(spark, sf_dir):
    return _thermal(spark, sf_dir, [])


@query
def d14_overtemp(spark, sf_dir):
    return inverter.overtemp_rows(staged(spark, sf_dir)).select(*ROW, "inverter_temp_c")


@query
def d15_overtemp_summer(spark, sf_dir):
    return inverter.overtemp(staged(spark, sf_dir))


@query
def d16_isolation_outliers(spark, sf_dir):
    return outliers.isolation_outliers(staged(spark, sf_dir))


@query
def d16_outlier_counts(spark, sf_dir):
    """Outliers by utility, with a reading in 199 heated and slowed down far beyond all others."""
    planted, number = F.col("reading_id") % 199 == 0, F.col("reading_id")
    rows = staged(spark, sf_dir).withColumns(
        {
            "inverter_temp_c": F.when(planted, 400.0 + number % 89).otherwise(F.col("inverter_temp_c")),
            "inverter_efficiency_pct": F.when(planted, 20.0 + number % 7).otherwise(F.col("inverter_efficiency_pct")),
        }
    )
    labelled = outliers.isolation_outliers_by(rows, ["utility"], keys=["reading_id"])
    counts = outliers.outlier_counts(labelled, ["utility"], "reading_id % 199 = 0")
    # Equal scores at the cut may leave out some rows; SQL can say no more than the share.
    share = F.col("n_outliers").between(F.floor(F.col("n_rows") * 0.04), F.ceil(F.col("n_rows") * 0.05))
    return counts.select("utility", "n_rows", "n_planted", "n_found", share.alias("share_held"))


# --- energy, report, data quality --------------------------------------------

_ENERGY = ["solar_kwh", "consumption_kwh", "grid_export_kwh", "grid_import_kwh"]
_ENERGY_MORE = ["net_energy_kwh", "self_consumption_pct", "export_credit_usd"]


@query
def e01_energy_totals(spark, sf_dir):
    sums = energy.energy_totals(staged(spark, sf_dir)).select(*ID, *_ENERGY, "net_energy_kwh")
    return rounded(sums, *_ENERGY, "net_energy_kwh")


@query
def e02_self_consumption_total(spark, sf_dir):
    sums = energy.energy_totals(staged(spark, sf_dir)).select(*ID, "self_consumption_pct")
    return rounded(sums, "self_consumption_pct")


@query
def e03_export_credit(spark, sf_dir):
    sums = energy.energy_totals(staged(spark, sf_dir)).select(*ID, "export_credit_usd")
    return rounded(sums, "export_credit_usd")


@query
def e04_utility_mode(spark, sf_dir):
    return energy.utility_mode(staged(spark, sf_dir))


@query
def e05_period(spark, sf_dir):
    return energy.reporting_period(staged(spark, sf_dir))


@query
def e06_cell_completeness(spark, sf_dir):
    return rounded(quality.cell_completeness(telemetry(spark, sf_dir)), "completeness_pct")


@query
def e07_inverter_status(spark, sf_dir):
    means = inverter.inverter_summary(staged(spark, sf_dir))
    return means.select("system_id", inverter.inverter_status(F.col(_MEAN_EFF)).alias("inverter_status"))


@query
def e08_dr_status(spark, sf_dir):
    flex = compliance.grouped(staged(spark, sf_dir), ID, compliance.flex_aggregates())
    reduction = F.coalesce(compliance.flex_reduction(), F.lit(0.0))
    return flex.select("system_id", report.dr_status(reduction).alias("flex_alert_participation"))


def _report(spark, sf_dir, by):
    """From the state of days, which one pass over the readings gives."""
    state = stored(daystate.day_state(staged(spark, sf_dir), ENGINE), "state")
    made = daystate.report_of(state, by, AS_OF)
    return _rounded_report(report.flat(made, by))


def _rounded_report(made):
    doubles = [f.name for f in made.schema if f.dataType == T.DoubleType()]
    made = steady(made, mean_efficiency_pct=F.col("total_data_points"))
    return rounded(made, *[c for c in doubles if c != _MEAN_EFF])


@query
def e09_monthly_report(spark, sf_dir):
    return _report(spark, sf_dir, ["system_id", "month"])


@query
def e09_utility_report(spark, sf_dir):
    return _report(spark, sf_dir, ["utility", "month"])


@query
def e10_system_completeness(spark, sf_dir):
    return rounded(
        quality.system_completeness(telemetry(spark, sf_dir), EXPECTED_SYSTEMS), "completeness_pct"
    )


@query
def e11_invalid_voltage(spark, sf_dir):
    return quality.invalid_voltage(telemetry(spark, sf_dir))


@query
def e12_freshness(spark, sf_dir):
    return rounded(quality.freshness(staged(spark, sf_dir), AS_OF), "data_age_hours")


@query
def e13_quality_gate(spark, sf_dir):
    gate = quality.quality_gate(telemetry(spark, sf_dir), AS_OF, EXPECTED_SYSTEMS)
    return rounded(gate, "completeness_pct", "data_age_hours")


# --- the daily run ------------------------------------------------------------


def _two_days(spark, sf_dir) -> str:
    """The daily run over two dated directories; the second has late readings and repeats of the first."""
    source, target = scratch_path(spark, "dated"), scratch_path(spark, "run")
    rows = telemetry(spark, sf_dir)
    first = F.coalesce(F.col("timestamp") < F.lit("2024-07-01").cast("timestamp_ntz"), F.lit(True))
    late, again = F.col("reading_id") % 50 == 0, F.col("reading_id") % 40 == 0
    days = {"2024-06-30": first & ~late, "2024-12-15": ~first | late | again}
    for day, there in days.items():
        readings.write_by(rows.where(there).withColumn("dt", F.lit(day).cast("date")), source, "dt")
    any_age = replace(LIMITS, freshness_max_hours=float("inf"))
    run_all_days(spark, source, target, dict.fromkeys(days, AS_OF), expected_systems=1, limits=any_age, start=None, step_hours=1.0)
    return target


@query
def run_days(spark, sf_dir):
    """The report that the second day stored."""
    target = _two_days(spark, sf_dir)
    schema = daystate.report_of(read_state(spark, target)).schema
    stored_report = spark.read.schema(schema).json(f"{target}/reports/dt=2024-12-15")
    return _rounded_report(report.flat(stored_report, ID))


# --- time series, demand response, marts, stream -----------------------------


@query
def x01_missing_readings(spark, sf_dir):
    return series.missing_readings(staged(spark, sf_dir), step_minutes=60, slots_per_block=24)


@query
def x01_missing_counts(spark, sf_dir):
    return series.missing_counts(staged(spark, sf_dir), step_minutes=60, slots_per_block=24)


@query
def x02_net_flow(spark, sf_dir):
    rows = telemetry(spark, sf_dir).drop("grid_import_kw", "grid_export_kw")
    return energy.net_flow(rows).select("reading_id", "grid_import_kw", "grid_export_kw")


@query
def x03_round_trip_eff(spark, sf_dir):
    rte = battery.round_trip_efficiency(staged(spark, sf_dir)).drop("rte_class")
    return rounded(rte, "charged_pct", "discharged_pct", "round_trip_efficiency_pct")


@query
def x04_thd(spark, sf_dir):
    return rounded(_captures(spark, sf_dir), "fundamental", "thd_pct")


@query
def x05_gaps(spark, sf_dir):
    return rounded(series.gaps(staged(spark, sf_dir)), "gap_hours")


@query
def x06_daily_completeness(spark, sf_dir):
    days = series.daily_completeness(staged(spark, sf_dir), expected_per_day=24)
    return rounded(days, "completeness_pct")


@query
def x07_dr_baseline(spark, sf_dir):
    base = demand_response.dr_baseline(staged(spark, sf_dir))
    return rounded(base, "baseline_kw", "actual_kw", "reduction_kw")


@query
def x08_dr_settlement(spark, sf_dir):
    paid = demand_response.dr_settlement(staged(spark, sf_dir))
    return rounded(paid, "reduced_kwh", "settlement_usd")


@query
def x09_sustained_episodes(spark, sf_dir):
    return rounded(series.sustained_episodes(staged(spark, sf_dir)), "minutes")


@query
def x09_stream_episodes(spark, sf_dir):
    """The same from a stream of three files: late readings and repeats come with the second.

    The third holds one reading without a system, so far ahead that the watermark passes all others.
    """
    source, out, state = (scratch_path(spark, n) for n in ("arriving", "episodes", "episodes-state"))
    rows = telemetry(spark, sf_dir)
    cut = F.lit("2024-07-01").cast("timestamp_ntz")
    first, number = F.col("timestamp") < cut, F.col("reading_id")
    late = (F.col("timestamp") >= cut - F.expr("INTERVAL 2 DAYS")) & (number % 3 == 0)
    ahead = rows.orderBy(F.desc("timestamp"), "reading_id").limit(1).withColumns(
        {"system_id": F.lit(None).cast("string"), "timestamp": F.expr("timestamp + INTERVAL 100 DAYS")}
    )
    again = (F.col("timestamp") >= cut - F.expr("INTERVAL 2 DAYS")) & first & ~late
    for part in (rows.where(first & ~late), rows.where(~first | late | again), ahead):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = monitor.file_stream(spark, source, rows.schema, max_files=1)
    found = episodes.stream_episodes(stream, watermark="3 days")
    episodes.start_episodes(found, out, state).awaitTermination()
    return episodes.latest_episodes(spark, out, found.schema).drop("closed")


@query
def x10_disconnect(spark, sf_dir):
    rows = vio.disconnects(staged(spark, sf_dir)).select(*ROW, "frequency_hz", "frequency_off_hz")
    return rounded(rows, "frequency_off_hz")


@query
def x11_battery_mart(spark, sf_dir):
    return rounded(marts.battery_mart(staged(spark, sf_dir)), *_HEALTH)


@query
def x12_energy_mart(spark, sf_dir):
    return rounded(energy.energy_mart(staged(spark, sf_dir)), *_ENERGY, *_ENERGY_MORE)


@query
def x12_energy_rollup(spark, sf_dir):
    sums = energy.energy_rollup(energy.energy_mart(staged(spark, sf_dir)))
    return rounded(sums, *_ENERGY, *_ENERGY_MORE)


@query
def x13_merge_sources(spark, sf_dir):
    """An app with energy values, a meter with gaps, and a coarse local logger."""
    rows = stored(staged(spark, sf_dir).select(*ROW, *MEASURES), "staged")
    app = rows.select(*ROW, *MEASURES[:6])
    meter = rows.select(*ROW, "voltage_v", "frequency_hz", "power_factor")
    logger = rows.select(
        *ROW,
        F.floor("consumption_kw").cast("double").alias("consumption_kw"),
        F.lit(240.0).alias("voltage_v"),
        F.when(F.col("frequency_hz").isNull(), F.lit(60.0)).alias("frequency_hz"),
        "inverter_temp_c",
        "inverter_efficiency_pct",
    )
    return merge.merge_sources({"app": app, "meter": meter, "logger": logger})


@query
def x13_merge_shifted(spark, sf_dir):
    """Sources whose clocks differ: a meter seven minutes ahead, a logger that reports every third hour."""
    rows = stored(staged(spark, sf_dir).select(*ROW, *MEASURES), "staged")
    earlier = lambda minutes: F.col("timestamp") - F.expr(f"INTERVAL {minutes} MINUTES")
    app = rows.select(*ROW, "solar_production_kw", "consumption_kw")
    meter = rows.select("system_id", earlier(7).alias("timestamp"), "voltage_v", "frequency_hz", "power_factor")
    logger = rows.where(F.hour("timestamp") % 3 == 0).select(
        "system_id", earlier(40).alias("timestamp"), F.lit(240.0).alias("voltage_v"), "inverter_temp_c", "inverter_efficiency_pct"
    )
    merged = merge.merge_sources_asof({"app": app, "meter": meter, "logger": logger}, tolerance_minutes=180)
    return rounded(merged, "meter_age_minutes", "logger_age_minutes")


def _arrivals(events):
    """Telemetry in order of arrival, with a zoned copy of its time."""
    rows = map_events(events, event_time="arrival")
    return rows.withColumn("event_time", F.col("timestamp").cast("timestamp"))


def _counts_as_ntz(counts):
    ends = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return counts.withColumns(ends)


@query
def x14_stream_counts(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = monitor.file_stream(spark, sf_dir, schema, name_filter="events.parquet")
    out, state = scratch_path(spark, "monitor"), scratch_path(spark, "monitor-state")
    counts = monitor.violation_counts(_arrivals(stream))
    monitor.start_latest(counts, out, state).awaitTermination()
    return _counts_as_ntz(monitor.latest_counts(spark, out, counts.schema))


@query
def x14_batch_counts(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return _counts_as_ntz(monitor.violation_counts(_arrivals(events)))


_EXPECTED = {
    "not_null": ["system_id", "timestamp", "voltage_v"],
    "unique_key": KEYS,
    "accepted": {"utility": ["PGE", "SCE"]},
    "ranges": {"voltage_v": (200.0, 280.0), "battery_soc_pct": (0.0, 100.0)},
}


@query
def x15_expectations(spark, sf_dir):
    return quality.expectations(telemetry(spark, sf_dir), **_EXPECTED)


@query
def x15_rows_set_aside(spark, sf_dir):
    """Failing rows of the stored table, with what they fail."""
    tagged = quality.tag_failures(telemetry(spark, sf_dir), **_EXPECTED, order=["reading_id"])
    table = quality.set_aside(tagged, scratch_path(spark, "set_aside"))
    return table.where("row_status = 'failing'").select(
        "reading_id", "system_id", "timestamp", F.array_join("failed_checks", ",").alias("failed_checks")
    )


@query
def x16_tou_split(spark, sf_dir):
    return rounded(battery.tou_split(staged(spark, sf_dir)), "charge_kwh", "discharge_kwh")


@query
def x16_tou_split_by_system(spark, sf_dir):
    return rounded(battery.tou_split(staged(spark, sf_dir), ID), "charge_kwh", "discharge_kwh")


@query
def x17_fade_rate(spark, sf_dir):
    return rounded(battery.fade_rate(staged(spark, sf_dir)), "soh_pct", "fade_pct_per_year")


@query
def x18_compliance_extract(spark, sf_dir):
    rates = ["voltage_compliance_pct", "frequency_compliance_pct", "pf_compliance_pct"]
    return rounded(marts.compliance_extract(staged(spark, sf_dir)), *rates)


@query
def x19_soh_fleet(spark, sf_dir):
    return rounded(marts.soh_fleet(staged(spark, sf_dir)), "min_soh_pct", "mean_soh_pct")


@query
def x19_worst_batteries(spark, sf_dir):
    return rounded(marts.worst_batteries(staged(spark, sf_dir)), "soh_pct", "equivalent_cycles")
