"""The gate's record taken with the staging pass equals the one of a scan of its own."""

import pytest
from pyspark.sql import functions as F

from fleetwatt.operators import quality, staging
from fleetwatt.plans.lineage import stored
from fleetwatt.queries import AS_OF, telemetry
from tests.conftest import SF_DIR

START = "2024-01-01 00:00:00"
CASES = {
    "clean": lambda df: df.where("voltage_v BETWEEN 90 AND 150 AND timestamp >= '2024-01-01'"),
    "invalid": lambda df: df.withColumn("voltage_v", F.expr("CASE WHEN reading_id % 7 = 0 THEN 1D ELSE voltage_v END")),
    "early": lambda df: df.withColumn("timestamp", F.expr("CASE WHEN system_id < 'S' OR reading_id % 5 = 0 THEN timestamp_ntz'2020-01-01 00:00:00' ELSE timestamp END")),
    "no time": lambda df: df.withColumn("timestamp", F.expr("CASE WHEN reading_id % 5 > 0 THEN timestamp END")),
    "no system": lambda df: df.withColumn("system_id", F.lit(None).cast("string")),
    "no rows": lambda df: df.where("reading_id < 0"),
    "no columns' values": lambda df: df.withColumn("voltage_v", F.lit(None).cast("double")),
}


@pytest.mark.parametrize("start", [None, START])
@pytest.mark.parametrize("case", CASES)
def test_equal_to_the_gate(spark, tmp_path, case, start):
    path = str(tmp_path / "t")
    CASES[case](telemetry(spark, SF_DIR)).write.parquet(path)
    raw = spark.read.parquet(path)
    rows, seen = quality.observe_gate(raw, start)
    new = stored(staging.stage(rows, start), "new")
    made = quality.observed_gate(raw, new, seen.get, AS_OF, 150)
    assert made.first() == quality.quality_gate(raw, AS_OF, 150).first()
    if case in ("clean", "invalid", "no time"):
        assert any(path in f for f in made.inputFiles()) == (case != "clean")
