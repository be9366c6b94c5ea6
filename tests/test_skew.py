"""One system holds most readings: series, quantiles and dedup stay exact."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fleetwatt.plans.chunks import runs, with_previous
from fleetwatt.plans.skew import exact_quantile
from fleetwatt.operators.staging import dedup_latest

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def series_rows():
    """A hot system over a year, one with a long silence, one with one reading."""
    rng = random.Random(7)
    rows = []
    for name, hours in (
        ("hot", sorted(rng.sample(range(24 * 365), 3000))),
        ("quiet", [0, 1, 2, 24 * 200, 24 * 200 + 1]),
        ("single", [5]),
    ):
        for h in hours:
            value = None if rng.random() < 0.05 else float(rng.randrange(0, 40))
            rows.append((name, START + timedelta(hours=h), value))
    return rows


@pytest.fixture(scope="module")
def series_df(spark, series_rows):
    shuffled = random.Random(1).sample(series_rows, len(series_rows))
    return spark.createDataFrame(shuffled, "system_id string, timestamp timestamp_ntz, value double").repartition(6)


@pytest.mark.parametrize("days", [1, 7, 400])
def test_previous_row_across_blocks(series_df, series_rows, days):
    got = with_previous(series_df, ["value", "timestamp"], ["system_id"], chunk_days=days).collect()
    expected, last = {}, {}
    for name, ts, value in series_rows:
        expected[name, ts] = last.get(name, (None, None))
        last[name] = (value, ts)
    assert len(got) == len(series_rows)
    for r in got:
        assert (r.previous_value, r.previous_timestamp) == expected[r.system_id, r.timestamp]


def brute_runs(rows, holds):
    found, current, owner = [], None, None
    for name, ts, value in rows:
        on = value is not None and holds(value)
        if name != owner:
            current, owner = None, name
        if on and current is None:
            current = [name, ts, ts, 0]
            found.append(current)
        if on:
            current[2], current[3] = ts, current[3] + 1
        else:
            current = None
    return sorted(map(tuple, found))


@pytest.mark.parametrize("days", [1, 7, 400])
@pytest.mark.parametrize("limit", [2.0, 20.0, 38.0])
def test_runs_across_blocks(series_df, series_rows, days, limit):
    got = runs(series_df, F.col("value") < limit, ["system_id"], chunk_days=days).collect()
    assert sorted(tuple(r) for r in got) == brute_runs(series_rows, lambda v: v < limit)


def test_one_run_over_all_blocks(spark):
    rows = [("A", START + timedelta(days=i)) for i in range(100)]
    df = spark.createDataFrame(rows, "system_id string, timestamp timestamp_ntz")
    row = runs(df, F.lit(True), ["system_id"], chunk_days=3).collect()
    assert [(r.run_start, r.run_end, r.n_readings) for r in row] == [(START, START + timedelta(days=99), 100)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(flags=st.lists(st.booleans(), min_size=1, max_size=40), days=st.integers(1, 5))
def test_runs_of_any_pattern(spark, flags, days):
    rows = [("A", START + timedelta(hours=13 * i), 1.0 if on else 0.0) for i, on in enumerate(flags)]
    df = spark.createDataFrame(rows, "system_id string, timestamp timestamp_ntz, value double")
    got = runs(df, F.col("value") > 0, ["system_id"], chunk_days=days).collect()
    assert sorted(tuple(r) for r in got) == brute_runs(rows, lambda v: v > 0)


@pytest.fixture(scope="module")
def valued(spark):
    rng = np.random.default_rng(3)
    hot = [("hot", float(v)) for v in np.round(rng.normal(50, 10, 20000), 2)]
    flat = [("flat", 7.0)] * 1000 + [("flat", None)] * 10
    wild = [("wild", float(v)) for v in rng.lognormal(0, 6, 500)]
    small = [("two", 1.0), ("two", 2.0), ("one", 5.0)]
    return hot + flat + wild + small


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, valued, share):
    df = spark.createDataFrame(valued, "k string, v double").repartition(5)
    got = {r.k: r.q for r in exact_quantile(df, ["k"], "v", share, "q").collect()}
    for k in {k for k, _ in valued}:
        values = [v for name, v in valued if name == k and v is not None]
        assert got[k] == pytest.approx(np.quantile(values, share), rel=1e-12)
    whole = exact_quantile(df, [], "v", share, "q").first().q
    assert whole == pytest.approx(np.quantile([v for _, v in valued if v is not None], share), rel=1e-12)


def test_exact_quantile_with_a_poor_sketch(spark, valued):
    df = spark.createDataFrame(valued, "k string, v double")
    got = {r.k: r.q for r in exact_quantile(df, ["k"], "v", 0.95, "q", accuracy=3).collect()}
    hot = [v for name, v in valued if name == "hot"]
    assert got["hot"] == pytest.approx(np.quantile(hot, 0.95), rel=1e-12)


def test_exact_quantile_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 9.0)], "k string, v double")
    got = {r.k: r.q for r in exact_quantile(df, ["k"], "v", 0.5, "q").collect()}
    assert got == {None: 2.0, "a": 9.0}


def test_copies_of_one_reading(spark):
    copies = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id) END AS system_id",
        "TIMESTAMP_NTZ'2024-07-01 00:00:00' AS timestamp",
        "TIMESTAMP_NTZ'2024-07-01 00:00:00' AS ingestion_timestamp",
        "id AS reading_id",
    )
    kept = dedup_latest(copies)
    assert kept.count() == 20001
    assert kept.where("system_id = 'hot'").first().reading_id == 29997
    # Each input task sends one row of the hot key, whatever the number of copies.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
