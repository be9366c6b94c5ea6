"""The stream gives the batch counts for every window it has closed."""

from pyspark.sql import functions as F

from fleetwatt.functions.wallclock import ntz
from fleetwatt.queries import _arrivals
from fleetwatt.streaming import monitor
from tests.conftest import SF_DIR


def run(spark, source, out, state, watermark="1 hour"):
    schema = spark.read.parquet(f"{SF_DIR}/events.parquet").schema
    stream = monitor.file_stream(spark, source, schema, "*.parquet", max_files=1)
    counts = monitor.violation_counts(_arrivals(stream), watermark=watermark)
    monitor.start_monitor(counts, out, state).awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


def test_end_state_has_the_open_windows(spark, tmp_path):
    """Repeats with other values and late rows arrive; every window is there at the end."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    events.where("ts < timestamp_ntz'2024-01-15'").coalesce(1).write.parquet(source)
    late = events.where("ts >= timestamp_ntz'2024-01-14 23:00:00'")
    late.coalesce(1).write.mode("append").parquet(source)
    schema = events.schema
    counts = monitor.violation_counts(_arrivals(monitor.file_stream(spark, source, schema, "*.parquet", max_files=1)), watermark="2 hours")
    monitor.start_latest(counts, out, state).awaitTermination()
    got = monitor.latest_counts(spark, out, counts.schema)
    assert rows_of(got) == rows_of(monitor.violation_counts(_arrivals(events)))


def test_of_conflicting_repeats_the_first_counts(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    rows = _arrivals(events).where("system_id IS NOT NULL")
    later = rows.withColumns({"voltage_v": F.lit(500.0), "event_time": F.expr("event_time + INTERVAL 1 MINUTE")})
    assert rows_of(monitor.violation_counts(rows.unionByName(later))) == rows_of(monitor.violation_counts(rows))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_stream_over_several_files_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    # Files in order of time, the last rows of each repeated in the next one.
    bounds = [("2024-01-01", "2024-01-11"), ("2024-01-10 23:00:00", "2024-01-21"), ("2024-01-20 23:00:00", "2024-02-01")]
    for low, high in bounds:
        part = events.where(f"ts >= timestamp_ntz'{low}' AND ts < timestamp_ntz'{high}'")
        part.coalesce(1).write.mode("append").parquet(source)
    got = run(spark, source, out, state, watermark="2 hours")
    last = events.agg(F.max("ts")).first()[0]
    batch = monitor.violation_counts(_arrivals(events)).where(
        F.col("window_end").cast("timestamp_ntz") <= ntz(last) - F.expr("INTERVAL 2 HOURS")
    )
    assert rows_of(got) == rows_of(batch)
    # Started again on the same checkpoint, nothing is read or written twice.
    assert rows_of(run(spark, source, out, state, watermark="2 hours")) == rows_of(batch)
