"""Episodes on a stream equal those of the table: late and repeated readings, a restart, open runs."""

from pyspark.sql import functions as F

from fleetwatt.operators.series import sustained_episodes
from fleetwatt.operators.staging import stage
from fleetwatt.queries import telemetry
from fleetwatt.streaming import episodes
from fleetwatt.streaming.monitor import file_stream
from tests.conftest import SF_DIR

COLUMNS = ["system_id", "run_start", "run_end", "n_readings"]


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()))


def clock(rows):
    """A reading without a system, far ahead: the watermark passes all others."""
    last = rows.orderBy(F.desc("timestamp")).limit(1)
    return last.withColumns({"system_id": F.lit(None).cast("string"), "timestamp": F.expr("timestamp + INTERVAL 100 DAYS")})


def run(spark, source, out, state, schema):
    found = episodes.stream_episodes(file_stream(spark, source, schema, max_files=1), watermark="3 days")
    episodes.start_episodes(found, out, state).awaitTermination()
    return episodes.latest_episodes(spark, out, found.schema)


def test_stream_equals_table(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = telemetry(spark, SF_DIR).where("timestamp < timestamp_ntz'2024-06-01'").drop("utility").cache()
    write = lambda df: df.coalesce(1).write.mode("append").parquet(source)
    middle = "timestamp_ntz'2024-02-15'"
    late = (F.col("timestamp") >= F.expr(f"{middle} - INTERVAL 2 DAYS")) & (F.col("reading_id") % 3 == 0)
    first = rows.where(f"timestamp < {middle}").where(~late)
    # A correction of a reading that still waits, and repeats.
    fixed = first.where(f"timestamp > {middle} - INTERVAL 2 DAYS").withColumns(
        {"voltage_v": F.lit(500.0), "ingestion_timestamp": F.expr("ingestion_timestamp + INTERVAL 300 DAYS")}
    )
    assert fixed.count() > 0
    still = rows.orderBy(F.desc("timestamp")).limit(1).withColumns({"system_id": F.lit("OPEN"), "voltage_v": F.lit(500.0)})
    still = still.withColumn("timestamp", F.explode(F.array("timestamp", F.expr("timestamp + INTERVAL 1 HOUR"))))
    extra = fixed.unionByName(still)
    write(first)
    run(spark, source, out, state, rows.schema)
    write(rows.where((F.col("timestamp") >= F.expr(middle)) | late).unionByName(fixed).unionByName(extra))
    run(spark, source, out, state, rows.schema)
    write(clock(rows))
    got = run(spark, source, out, state, rows.schema)
    want = rows_of(sustained_episodes(stage(rows.unionByName(extra))))
    assert rows_of(got) == want and len(want) > 5
    assert "OPEN" in [r.system_id for r in got.where("NOT closed").collect()]
    # Started again on the same checkpoint, nothing is written twice.
    files = spark.read.parquet(out).count()
    assert rows_of(run(spark, source, out, state, rows.schema)) == want
    assert spark.read.parquet(out).count() == files
