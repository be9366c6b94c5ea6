"""Isolation forest: share, planted points, independence from partitions."""

import numpy as np
from pyspark.sql import functions as F

from fleetwatt.operators import outliers
from fleetwatt.operators.outliers import isolation_outliers


def labels(df, **options):
    rows = isolation_outliers(df, **options).where("label = -1").collect()
    return sorted((r.system_id, r.timestamp) for r in rows)


def test_share_and_repeatability(staged_rows):
    found = labels(staged_rows)
    assert 0.04 * 905 <= len(found) <= 0.06 * 905
    assert labels(staged_rows.repartition(7)) == found
    assert labels(staged_rows, seed=1) != found


def test_planted_points_and_nulls(spark):
    plain = spark.range(3000).selectExpr(
        "concat('S', id) AS system_id",
        "TIMESTAMP_NTZ'2024-07-01 00:00:00' AS timestamp",
        "40D + (id * 7919) % 100 / 10D AS inverter_temp_c",
        "97D + (id * 104729) % 100 / 100D AS inverter_efficiency_pct",
    )
    planted = plain.where("id < 5" if "id" in plain.columns else "system_id IN ('S0','S1','S2','S3','S4')")
    far = planted.withColumns(
        {
            "system_id": F.concat(F.lit("far-"), "system_id"),
            "inverter_temp_c": F.lit(120.0),
            "inverter_efficiency_pct": F.lit(60.0),
        }
    )
    empty = planted.withColumns(
        {"system_id": F.concat(F.lit("null-"), "system_id"), "inverter_temp_c": F.lit(None).cast("double")}
    )
    out = isolation_outliers(plain.unionByName(far).unionByName(empty), contamination=0.01)
    assert out.count() == 3005
    flagged = {r.system_id for r in out.where("label = -1").collect()}
    assert {f"far-S{i}" for i in range(5)} <= flagged and len(flagged) <= 31


def test_fewer_rows_than_a_sample(spark, staged_rows):
    few = staged_rows.orderBy("system_id", "timestamp").limit(40)
    assert isolation_outliers(few, trees=20).count() == 40


def test_a_forest_per_group(spark, monkeypatch):
    """What is far off in one group is normal in the other; parts and partitions change nothing."""
    rng = np.random.default_rng(1)
    rows = [(g, i, float(m + rng.normal()), float(-m + rng.normal())) for g, m in (("a", 0), ("b", 50), (None, 100)) for i in range(300)]
    rows += [("a", 1000, 50.0, -50.0), ("b", 1001, 0.0, 0.0), (None, 1002, None, 1.0), ("one", 1003, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "grp string, id int, x double, y double")
    options = {"features": ["x", "y"], "keys": ["id", "grp"], "trees": 20, "size": 64}
    labelled = outliers.isolation_outliers_by(df, ["grp"], **options)
    counts = {r.grp: (r.n_rows, r.n_outliers, r.n_planted, r.n_found) for r in outliers.outlier_counts(labelled, ["grp"], "id >= 1000").collect()}
    assert counts == {"a": (301, 15, 1, 1), "b": (301, 15, 1, 1), None: (300, 15, 0, 0), "one": (1, 0, 1, 0)}
    monkeypatch.setattr(outliers, "SCORED_TOGETHER", 40)
    again = outliers.isolation_outliers_by(df.repartition(7), ["grp"], **options)
    found = lambda r: sorted((str(x.grp), x.id, round(x.anomaly_score, 12), x.label) for x in r.collect())
    assert found(again) == found(labelled)
    assert outliers.isolation_outliers_by(df.limit(0), ["grp"], **options).count() == 0
