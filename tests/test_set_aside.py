"""Rows that fail expectations, set aside in one table."""

from collections import Counter

from pyspark.sql import functions as F

from fleetwatt.operators.quality import expectations, set_aside, tag_failures
from fleetwatt.queries import _EXPECTED, telemetry
from tests.conftest import SF_DIR


def test_counts_and_union(spark, tmp_path):
    raw = telemetry(spark, SF_DIR)
    table = set_aside(tag_failures(raw, **_EXPECTED, order=["reading_id"]), str(tmp_path / "table"))
    counted = {r.expectation: r.failed_rows for r in expectations(raw, **_EXPECTED).collect()}
    failed = Counter(r.name for r in table.select(F.explode("failed_checks").alias("name")).collect())
    assert {n: failed[n] for n in counted} == counted and set(failed) <= set(counted)
    assert Counter(map(str, table.select(raw.columns).collect())) == Counter(map(str, raw.collect()))


def test_a_hot_key_nulls_and_no_rows(spark):
    rows = [(i, "A", 1, 5.0) for i in range(50)] + [(50, None, 1, None), (51, None, 1, 99.0), (52, "B", 1, None)]
    df = spark.createDataFrame(rows, "reading_id int, k string, failed int, v double")
    want = dict(not_null=["k"], unique_key=["k", "failed"], accepted={}, ranges={"v": (0.0, 10.0)})
    out = {r.reading_id: r.failed_checks for r in tag_failures(df, **want, order=["reading_id"]).collect()}
    assert len(out) == 53 and out[0] == [] and out[52] == []
    assert all(out[i] == ["unique_k_failed"] for i in range(1, 50))
    assert out[50] == ["not_null_k"] and out[51] == ["not_null_k", "range_v"]
    assert tag_failures(df.limit(0), **want, order=["reading_id"]).count() == 0
