"""Quantiles from daily histograms equal those of all values, for any period."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwatt.operators import histograms, inverter, report
from fleetwatt.operators.daystate import battery_of, day_state, report_of
from fleetwatt.plans.lineage import stored
from tests.test_plans import plan_of

NAMES = {"mean": "mean", "max": "max", "quantile": "q"}


def _rows(spark, values, days=3):
    rows = [(s, i % days, v) for s, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "system_id string, d int, v double")
    return df.select("system_id", F.expr("date'2024-01-30' + d").alias("date"), "v")


def _by_hand(values, share):
    known = [v for v in values if v is not None]
    return (len(values), max(known) if known else None, float(np.quantile(known, share)) if known else None)


@pytest.mark.parametrize("share", [0.0, 0.37, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("width", [1.0 / 64.0, 8.0])
def test_equal_to_all_values(spark, share, width):
    rng = np.random.default_rng(5)
    values = {
        "plain": rng.normal(40, 9, 500).tolist(),
        "ties": [41.5] * 300 + [20.0] * 7 + [None] * 5,
        "far": [-1e300, 1e300, 0.0, -0.5, 1e9, 2e9, 3e9],
        "one": [3.25],
        "pair": [1.0, 200.0],
        "none": [None, None],
    }
    df = _rows(spark, values)
    made = histograms.daily_histograms(df, "v", width=width)
    got = {r.system_id: r for r in histograms.summary_of_days(made, df, "v", ["system_id"], share, NAMES, width).collect()}
    assert got.keys() == values.keys()
    for name, vs in values.items():
        n, top, q = _by_hand(vs, share)
        assert (got[name].n_readings, got[name].max) == (n, top)
        assert got[name].q == (None if q is None else pytest.approx(q, rel=1e-12))
    everything = [v for vs in values.values() for v in vs]
    fleet = histograms.summary_of_days(made, df, "v", [], share, NAMES, width).first()
    n, top, q = _by_hand(everything, share)
    assert (fleet.n_readings, fleet.max, fleet.q) == (n, top, pytest.approx(q, rel=1e-12))


def test_no_readings(spark):
    df = _rows(spark, {"a": [1.0]}).limit(0)
    made = histograms.daily_histograms(df, "v")
    assert histograms.summary_of_days(made, df, "v", ["system_id", "month"], 0.5, NAMES).count() == 0


def test_at_most_four_exchanges_and_bins_only(spark, staged_rows):
    state = stored(inverter.temperature_histograms(staged_rows), "histograms")
    place = plan_of(histograms.located(state, ["system_id", "month"], 0.95))
    last = plan_of(inverter.thermal_of_days(state, staged_rows))
    assert (place + last).count("Exchange") <= 4
    assert plan_of(inverter.temperature_histograms(staged_rows)).count("Exchange") == 1


def test_groups_meet_their_bins_without_copies(spark, staged_rows):
    """A table of many groups must not grow on its way into the join: Spark sizes it by its files."""
    state = stored(inverter.temperature_histograms(staged_rows), "histograms")
    groups = state.select("system_id", F.trunc("date", "month")).distinct().count()
    last = inverter.thermal_of_days(state, staged_rows)
    assert last.count() == groups
    assert "_salt" not in plan_of(last)
    assert "array_distinct(array(first_bin" in plan_of(last)


@pytest.mark.parametrize("by", [["utility"], []])
def test_a_groups_cycles_are_those_of_a_system(spark, staged_rows, by):
    """The swing between two systems' charges is no cycle of either battery."""
    single = {r.system_id: r for r in battery_of(day_state(staged_rows), ["utility", "system_id"]).collect()}
    state = stored(day_state(staged_rows), "state")
    for made in (report_of(state, by), report.monthly_report(staged_rows, by=by)):
        for r in made.collect():
            mine = [s.equivalent_cycles for s in single.values() if not by or s.utility == r.utility]
            assert r.battery.equivalent_cycles == pytest.approx(sum(mine) / len(mine))
