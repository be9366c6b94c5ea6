"""The physical plans have the shape large tables need."""

import pytest
from pyspark.sql import functions as F

from fleetwatt.config import JOB
from fleetwatt.operators import battery, inverter, series, staging, violations
from fleetwatt.queries import QUERIES, telemetry
from fleetwatt.sources.readings import read_telemetry
from tests.conftest import SF_DIR

# These run jobs while they build their result; their parts are checked below.
EAGER = {"a06_write_roundtrip", "a03_day_slice", "x14_stream_counts", "d16_isolation_outliers"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER))
def test_no_products_of_tables(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_key_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    telemetry(spark, SF_DIR).write.parquet(path)
    plan = plan_of(staging.stage(read_telemetry(spark, path), "2024-01-01 00:00:00").select("system_id", "voltage_v"))
    assert "IsNotNull(system_id)" in plan and "GreaterThanOrEqual(timestamp,2024-01-01T00:00)" in plan
    # Only the columns asked for, and those that rank the copies, are read.
    schema = plan.split("ReadSchema: ")[1]
    assert "voltage_v" in schema and "frequency_hz" not in schema


def test_violations_add_no_shuffle(staged_rows):
    assert "Exchange" not in plan_of(violations.violations(staged_rows))


def test_one_scan_and_shuffle_per_rate(staged_rows):
    plan = plan_of(battery.state_of_health(staged_rows))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2


def test_series_branches_share_one_exchange(staged_rows, no_broadcast):
    for df in (battery.round_trip_efficiency(staged_rows), series.gaps(staged_rows),
               series.sustained_episodes(staged_rows)):
        df.collect()
        final = plan_of(df).split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_no_window_over_a_whole_series_of_readings(staged_rows, no_broadcast):
    """A window by system alone runs over block rows, never over readings."""
    for df in (battery.soc_events(staged_rows), series.gaps(staged_rows)):
        for line in plan_of(df).splitlines():
            if "Window [" in line and "timestamp" in line.split("windowspecdefinition")[1].split("specifiedwindowframe")[0]:
                assert "_chunk" in line


def test_exact_quantile_has_no_group_buffer(staged_rows):
    assert " percentile(" not in plan_of(inverter.thermal_summary(staged_rows))


def test_sketch_is_one_pass(staged_rows):
    plan = plan_of(inverter.thermal_summary(staged_rows, exact=False))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_limits_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = telemetry(spark, SF_DIR)
    odd = F.col("reading_id") % 3 == 0
    rows.withColumn("voltage_v", F.when(odd, F.lit(float("nan"))).otherwise(F.col("voltage_v"))).write.parquet(path)
    wide = violations.wide_violations(read_telemetry(spark, path, None, only=violations.beyond_limits(JOB)), JOB)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    pushed = plan_of(wide).split("PushedFilters: ")[1].split("ReadSchema")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for limit in ("LessThan(voltage_v,", "GreaterThan(frequency_hz,", "LessThan(power_factor,"):
        assert limit in pushed
    # NaN passes the scan's filter, not the check.
    assert wide.exceptAll(violations.wide_violations(read_telemetry(spark, path, None), JOB)).count() == 0
    assert wide.count() == violations.wide_violations(read_telemetry(spark, path, None), JOB).count() > 0
    assert wide.where("reading_id % 3 = 0 AND voltage_violation IS NOT NULL").count() == 0
