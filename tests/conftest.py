from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("fleetwatt-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        # Operators work on wall-clock time: a zone with clock changes must not matter.
        .config("spark.sql.session.timeZone", "America/Los_Angeles")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def staged_rows(spark):
    """Staged telemetry of the smallest scale, stored once."""
    from fleetwatt.plans.lineage import stored
    from fleetwatt.queries import staged

    return stored(staged(spark, SF_DIR), "staged")


def telemetry_rows(spark, rows: list[dict]):
    """Staged telemetry from a few literal readings; unnamed columns are NULL."""
    from datetime import datetime

    from fleetwatt.operators.staging import quality_flags, self_consumption, with_calendar
    from fleetwatt.schema import RAW_SCHEMA

    data = []
    for i, row in enumerate(rows):
        full = {**dict.fromkeys(RAW_SCHEMA.names), "reading_id": i, "system_id": "A", **row}
        for name in ("timestamp", "ingestion_timestamp"):
            if isinstance(full[name], str):
                full[name] = datetime.fromisoformat(full[name])
        data.append(tuple(full[name] for name in RAW_SCHEMA.names))
    raw = spark.createDataFrame(data, RAW_SCHEMA)
    return quality_flags(self_consumption(with_calendar(raw)))
