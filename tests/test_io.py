"""Sources, sinks and the daily pipeline."""

import glob
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetwatt.config import ENGINE
from fleetwatt.operators.quality import QualityGateError, conformance
from fleetwatt.operators.report import flat, monthly_report
from fleetwatt.operators.violations import violations, wide_violations
from fleetwatt.operators import daystate
from fleetwatt.operators.battery import round_trip_efficiency, state_of_health
from fleetwatt.operators.energy import energy_mart
from fleetwatt.operators.marts import soh_fleet
from fleetwatt.operators.staging import stage
from fleetwatt.plans import daily, lineage
from fleetwatt.plans.daily import read_state, run_day, run_days
from fleetwatt.plans.jobs import run_ingest, run_violations
from fleetwatt.plans.lineage import scratch_path, shared_dir
from fleetwatt.queries import telemetry
from fleetwatt.schema import RAW_SCHEMA, TELEMETRY_SCHEMA
from fleetwatt.sources import readings
from tests.conftest import SF_DIR, telemetry_rows


def test_shared_dir_is_the_cluster_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_read_turns_nan_into_null(spark, tmp_path):
    path = str(tmp_path / "t")
    telemetry(spark, SF_DIR).withColumn("voltage_v", F.lit(float("nan"))).write.parquet(path)
    assert readings.read_telemetry(spark, path).where("voltage_v IS NOT NULL").count() == 0


def test_rewriting_one_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = telemetry(spark, SF_DIR).where("timestamp BETWEEN '2024-03-01' AND '2024-03-05'")
    readings.write_telemetry(rows, path)
    before = readings.read_telemetry(spark, path, None).count()
    day = rows.where(F.to_date("timestamp") == "2024-03-02")
    readings.write_telemetry(day.limit(1), path)
    after = readings.read_telemetry(spark, path, None)
    assert after.count() == before - day.count() + 1


def test_day_read_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "dt")
    rows = telemetry(spark, SF_DIR).withColumn("dt", F.to_date("timestamp"))
    readings.write_by(rows.where("dt BETWEEN '2024-03-01' AND '2024-03-03'"), path, "dt")
    day = readings.read_day(spark, path, "2024-03-02", RAW_SCHEMA)
    assert len(day.inputFiles()) >= 1 and all("dt=2024-03-02" in f for f in day.inputFiles())
    assert readings.read_day(spark, path, "2024-07-01", RAW_SCHEMA).count() == 0
    assert day.schema["dt"].dataType.simpleString() == "date"
    assert day.count() == rows.where("dt = '2024-03-02'").count()


def test_conformance_names_the_missing_column(spark):
    found = {r.column_name: r for r in conformance(telemetry(spark, SF_DIR).drop("power_factor")).collect()}
    assert len(found) == len(TELEMETRY_SCHEMA)
    assert not found["power_factor"].is_present and not found["power_factor"].conforms
    assert found["voltage_v"].conforms and not found["system_id"].conforms


def test_materialize(spark, staged_rows):
    staged_rows = staged_rows.where("timestamp >= timestamp_ntz'2024-01-01'")
    view = readings.materialize(staged_rows, "staged_view", "view")
    table = readings.materialize(violations(staged_rows, as_of="2024-12-16 00:00:00"), "mart_table", "table")
    assert view.count() == 905 and table.count() == 432
    assert spark.sql("SELECT count(*) FROM mart_table m JOIN staged_view s USING (system_id, timestamp)").first()[0] == 432
    with pytest.raises(ValueError):
        readings.materialize(staged_rows, "x", "cube")


def test_report_document(spark, staged_rows, tmp_path):
    path = str(tmp_path / "report")
    report = monthly_report(staged_rows, ENGINE, ["system_id", "month"], as_of="2024-12-16 00:00:00")
    readings.write_report(report, path)
    lines = [json.loads(l) for f in glob.glob(f"{path}/*.json") for l in open(f)]
    assert len(lines) == report.count()
    assert set(lines[0]) == {
        "system_id", "month", "report_metadata", "compliance", "energy", "demand_response", "battery",
        "inverter", "data_quality",
    }


def test_ingest_and_violations_jobs(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "violations")
    rows = telemetry(spark, SF_DIR).where("timestamp < '2024-02-01'").drop("ingestion_timestamp")
    with pytest.raises(QualityGateError, match="system_id"):
        run_ingest(rows, raw)
    keyed = rows.where("system_id IS NOT NULL")
    text = keyed.withColumn("voltage_v", F.when(F.col("reading_id") % 2 == 0, F.col("voltage_v").cast("string")).otherwise("?"))
    with pytest.raises(QualityGateError, match="voltage_v"):
        run_ingest(text, raw)
    stats = run_ingest(keyed, raw, "2024-12-16 00:00:00")
    assert stats["total_records"] == keyed.count()
    assert run_violations(spark, raw, out) == wide_violations(keyed).count()
    assert readings.read_telemetry(spark, raw, None).first().ingestion_timestamp == datetime(2024, 12, 16)


def test_pipeline_over_two_sources(spark, tmp_path):
    app, meter, target = (str(tmp_path / n) for n in ("app", "meter", "out"))
    rows = telemetry(spark, SF_DIR).withColumns(
        {
            "timestamp": F.expr(
                "timestamp_ntz'2024-03-02 00:00:00' + make_dt_interval(0, CAST(reading_id % 24 AS INT))"
            ),
            "dt": F.lit("2024-03-02").cast("date"),
        }
    )
    readings.write_by(rows.drop("voltage_v", "frequency_hz"), app, "dt")
    readings.write_by(rows.select("system_id", "timestamp", "ingestion_timestamp", "voltage_v", "frequency_hz", "dt"), meter, "dt")
    run_day(spark, {"app": app, "meter": meter}, target, "2024-03-02", datetime(2024, 3, 3), 15)
    staged = spark.read.parquet(f"{target}/staging")
    assert staged.where("n_sources <> 2 OR best_source <> 'app'").count() == 0
    assert 0 < staged.where("voltage_v IS NULL").count() < staged.where("voltage_v IS NOT NULL").count()
    assert staged.where("solar_production_kw IS NULL").count() == 0


def test_one_day_of_the_pipeline(spark, tmp_path):
    source, target, day = str(tmp_path / "raw"), str(tmp_path / "out"), "2024-03-02"
    rows = telemetry(spark, SF_DIR).withColumn("timestamp", F.expr(
        "timestamp_ntz'2024-03-02 00:00:00' + make_dt_interval(0, CAST(reading_id % 24 AS INT))"
    ))
    readings.write_by(rows.withColumn("dt", F.to_date("timestamp")), source, "dt")
    as_of = datetime(2024, 3, 3)
    done = run_day(spark, source, target, day, as_of, expected_systems=15)
    staged = spark.read.parquet(f"{target}/staging")
    mart = spark.read.parquet(f"{target}/violations")
    assert done["critical_violations"] == mart.where("severity = 'CRITICAL'").count() > 0
    n_violations = mart.count()
    assert staged.count() == staged.select("system_id", "timestamp").distinct().count()
    assert spark.read.json(f"{target}/reports").count() == 15
    # A second run replaces the day.
    run_day(spark, source, target, day, as_of, expected_systems=15)
    assert spark.read.parquet(f"{target}/violations").count() == n_violations
    with pytest.raises(QualityGateError):
        run_day(spark, source, target, day, as_of, expected_systems=500)


def _raw_days(spark):
    """Readings of two days' directories: late ones, a reading in both, a corrected one."""
    rows = telemetry(spark, SF_DIR).withColumns(
        {
            "timestamp": F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(CAST(reading_id % 2 AS INT), CAST(reading_id % 24 AS INT))"),
            "dt": F.expr("date'2024-03-01' + CAST(reading_id % 2 AS INT)"),
        }
    )
    late = rows.where("reading_id % 50 = 0").withColumns({"dt": F.lit("2024-03-02").cast("date"), "voltage_v": F.lit(1.0)})
    late = late.withColumn("ingestion_timestamp", F.expr("ingestion_timestamp + INTERVAL 60 DAYS"))
    again = rows.where("reading_id % 40 = 0").withColumn("dt", F.lit("2024-03-02").cast("date"))
    return rows.where("reading_id % 10 <> 2").unionByName(late).unionByName(again).unionByName(
        rows.where("reading_id % 10 = 2").withColumn("dt", F.lit("2024-03-02").cast("date"))
    )


def test_two_days_equal_both_at_once(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = _raw_days(spark)
    readings.write_by(rows, source, "dt")
    run_day(spark, source, target, "2024-03-01", datetime(2024, 3, 2), 15, step_hours=1.0)
    first = spark.read.parquet(f"{target}/staging").count()
    run_day(spark, source, target, "2024-03-02", datetime(2024, 3, 3), 15, step_hours=1.0)
    whole = stage(rows.drop("dt"), "2024-01-01 00:00:00")
    staged = spark.read.parquet(f"{target}/staging")
    assert first < staged.where("date = '2024-03-01'").count()
    assert sorted(map(str, staged.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    marts = {"violations": violations(whole, as_of="2024-03-03 00:00:00"), "energy": energy_mart(whole)}
    for name, want in marts.items():
        columns = [c for c in want.columns if c not in ("analysis_timestamp",) and not c.endswith("kwh") and not c.endswith("usd")]
        got = spark.read.parquet(f"{target}/{name}").select(columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(columns).collect())), name
    health = spark.read.parquet(f"{target}/battery").where("dt = '2024-03-02'")
    assert {r.system_id: r.days_in_service for r in health.collect()} == {
        r.system_id: r.days_in_service for r in state_of_health(whole, ["system_id"]).collect()
    }
    assert health.agg(F.max("days_in_service")).first()[0] == 1
    # The second day once more changes nothing.
    run_day(spark, source, target, "2024-03-02", datetime(2024, 3, 3), 15, step_hours=1.0)
    assert spark.read.parquet(f"{target}/staging").count() == whole.count()


def test_a_day_reads_its_own_dates_only(spark, tmp_path):
    """Readings planted in an old partition after its day was run do not reach later tables."""
    source, target = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = _raw_days(spark)
    old = rows.withColumn("timestamp", F.expr("timestamp - INTERVAL 10 DAYS")).withColumn("dt", F.expr("dt - 10"))
    readings.write_by(rows.unionByName(old), source, "dt")
    options = {"expected_systems": 15, "step_hours": 1.0}
    run_days(spark, source, target, {"2024-02-20": datetime(2024, 2, 21), "2024-02-21": datetime(2024, 2, 22)}, **options)
    ghost = spark.read.parquet(f"{target}/staging").where("date = '2024-02-20'").limit(1)
    ghost.withColumn("system_id", F.lit("GHOST")).drop("date").write.mode("append").parquet(f"{target}/staging/date=2024-02-20")
    assert spark.read.parquet(f"{target}/staging").where("system_id = 'GHOST'").count() == 1
    run_days(spark, source, target, {"2024-03-01": datetime(2024, 3, 2), "2024-03-02": datetime(2024, 3, 3)}, **options)
    health = spark.read.parquet(f"{target}/battery").where("dt = '2024-03-02'")
    whole = stage(rows.unionByName(old).drop("dt"))
    by_system = lambda df, c: {r.system_id: round(r[c], 9) for r in df.collect()}
    for c in ("days_in_service", "equivalent_cycles", "soh_pct"):
        assert by_system(health, c) == by_system(state_of_health(whole, ["system_id"]), c)
    state = read_state(spark, target)
    assert by_system(daystate.round_trip_of(state), "charged_pct") == by_system(round_trip_efficiency(whole), "charged_pct")
    fleet = lambda df: sorted((r.utility, r.n_systems, r.healthy, round(r.mean_soh_pct, 9)) for r in df.collect())
    assert fleet(daystate.fleet_of(state)) == fleet(soh_fleet(whole))


def test_marts_do_not_read_the_partitions_again(spark, tmp_path, monkeypatch):
    """The staged dates are read once, to merge with; what follows takes the merged rows."""
    source, target, seen, reads = str(tmp_path / "raw"), str(tmp_path / "out"), [], []
    rows = _raw_days(spark)
    readings.write_by(rows, source, "dt")
    days, marts = daily._days, daily.compliance_extract
    monkeypatch.setattr(daily, "_days", lambda *a: reads.append(a) or days(*a))
    monkeypatch.setattr(daily, "compliance_extract", lambda df, *a: seen.append(df) or marts(df, *a))
    for day in (1, 2):
        run_day(spark, source, target, f"2024-03-0{day}", datetime(2024, 3, day + 1), 15, step_hours=1.0)
    staged = spark.read.parquet(f"{target}/staging")
    assert len(reads) == 2
    assert not any(target in name for name in seen[1].inputFiles())
    assert sorted(map(str, staged.select(seen[1].columns).collect())) == sorted(map(str, seen[1].collect()))


@pytest.mark.parametrize("by", [["system_id", "month"], ["utility", "month"], ["system_id"], ["utility"]])
def test_reports_of_the_state_equal_those_of_the_readings(spark, staged_rows, by):
    state = lineage.stored(daystate.day_state(staged_rows), "state")
    made, want = (flat(r, by) for r in (daystate.report_of(state, by), monthly_report(staged_rows, by=by)))
    rounded = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in df.collect())
    assert made.columns == want.columns and rounded(made) == rounded(want)


def test_day_state_of_awkward_readings(spark):
    """NULL charge at the ends of a day, one reading, no utility, no rows."""
    rows = telemetry_rows(spark, [
        {"timestamp": "2024-03-01 01:00:00", "battery_soc_pct": None},
        {"timestamp": "2024-03-01 02:00:00", "battery_soc_pct": 50.0},
        {"timestamp": "2024-03-01 03:00:00", "battery_soc_pct": 40.0},
        {"timestamp": "2024-03-02 01:00:00", "battery_soc_pct": 70.0},
        {"timestamp": "2024-03-03 01:00:00", "battery_soc_pct": None},
        {"timestamp": "2024-03-04 01:00:00", "battery_soc_pct": 10.0},
        {"system_id": "B", "timestamp": "2024-03-04 01:00:00", "battery_soc_pct": None},
    ])
    state = daystate.day_state(rows)
    for df in (rows, rows.withColumn("utility", F.lit("X")), rows.limit(0)):
        got = {r.system_id: tuple(r) for r in daystate.round_trip_of(daystate.day_state(df)).collect()}
        assert got == {r.system_id: tuple(r) for r in round_trip_efficiency(df).collect()}
    assert {r.system_id: r.equivalent_cycles for r in daystate.battery_of(state).collect()} == {"A": 0.1, "B": 0.0}


def test_every_source_passes_the_gate(spark, tmp_path):
    app, meter = str(tmp_path / "app"), str(tmp_path / "meter")
    rows = _raw_days(spark).where("dt = '2024-03-02'")
    readings.write_by(rows.drop("voltage_v"), app, "dt")
    readings.write_by(rows.select("system_id", "timestamp", "ingestion_timestamp", "voltage_v", "dt"), meter, "dt")
    done = run_day(spark, {"app": app, "meter": meter}, str(tmp_path / "out"), "2024-03-02", datetime(2024, 3, 3), 15)
    assert done["invalid_voltage_records"] > 0 and not done["voltage_passed"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        applicationId = "app"

        def __init__(self, master):
            self.master = master

    class Session:
        def __init__(self, master, named=None):
            self.sparkContext = Context(master)
            self.conf = {"spark.checkpoint.dir": named} if named else {}

    with pytest.raises(RuntimeError):
        lineage.shared_dir(Session("spark://host:7077"))
    assert lineage.shared_dir(Session("spark://host:7077", "s3://bucket/x")) == "s3://bucket/x"
    assert lineage.shared_dir(Session("local[4]")) == lineage.shared_dir(Session("local[4]"))
