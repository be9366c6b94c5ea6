"""As-of matches against a plain search, at bucket edges, with ties and NULLs."""

import random
from datetime import datetime, timedelta

import pytest

from fleetwatt.operators.merge import asof_match, merge_sources_asof

START = datetime(1969, 12, 31, 20)  # buckets before 1970, too
L, R = "system_id string, timestamp timestamp_ntz, a int", "system_id string, timestamp timestamp_ntz, v int"


@pytest.mark.parametrize("tolerance", [1, 10, 60])
def test_against_a_plain_search(spark, tolerance):
    rnd = random.Random(tolerance)
    at = lambda: START + timedelta(minutes=rnd.randrange(600))
    left = [(s, at(), i) for s in ("A", "B", None) for i in range(120)] + [("A", None, 999)]
    right = {(s, at()): i for s in ("A", "B", None) for i in range(60)}
    right[("A", START)] = None
    rows = [(s, t, v) for (s, t), v in right.items()] + [("A", None, 5)]
    out = asof_match(spark.createDataFrame(left, L), spark.createDataFrame(rows, R).repartition(3), ["system_id"], tolerance, "m").collect()
    assert len(out) == len(left)
    for r in out:
        near = [t for (s, t) in right if s == r.system_id and r.timestamp and t <= r.timestamp <= t + timedelta(minutes=tolerance)]
        want = (max(near), right[(r.system_id, max(near))]) if near else None
        assert (tuple(r.m) if r.m else None) == want


def test_merge_takes_the_first_value(spark):
    app = spark.createDataFrame([("A", START, 1), ("A", START + timedelta(hours=5), None), ("C", START, 3)], L)
    meter = spark.createDataFrame([("A", START - timedelta(minutes=3), 7)], R)
    logger = spark.createDataFrame([("A", START + timedelta(hours=4, minutes=55), 9)], R).withColumnRenamed("v", "a")
    out = {(r.system_id, r.timestamp): r for r in merge_sources_asof({"app": app, "meter": meter, "logger": logger}, 10).collect()}
    first, later, other = out[("A", START)], out[("A", START + timedelta(hours=5))], out[("C", START)]
    assert (first.a, first.v, first.n_sources, first.meter_age_minutes, first.logger_age_minutes) == (1, 7, 2, 3.0, None)
    assert (later.a, later.v, later.n_sources, later.logger_age_minutes) == (9, None, 2, 5.0)
    assert (other.a, other.v, other.n_sources) == (3, None, 1)
    assert merge_sources_asof({"app": app.limit(0), "meter": meter}, 10).count() == 0


def test_plan_has_no_join(spark):
    df = spark.createDataFrame([("A", START, 1)], L)
    plan = merge_sources_asof({"a": df, "b": df.withColumnRenamed("a", "v")}, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
