"""Sustained voltage episodes on a stream: runs kept as keyed state, closed by good readings.

Readings wait until the watermark has passed their time, so late ones take their place and of repeats
the newest counts, as in staging. Then they are taken in order: a violation opens or extends the
system's run, a good reading closes it. Each step is made by an event-time timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from fleetwatt.config import ENGINE, LIMITS, GridCode
from fleetwatt.functions.scalars import null_if_nan
from fleetwatt.operators.violations import breaks, voltage_normal
from fleetwatt.schema import MEASURES

GOOD, BAD, MISSING = 0, 1, 2
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "at array<bigint>, kind array<int>, seen array<bigint>, id array<bigint>, opened bigint, latest bigint, readings bigint"
_OUTPUT = "system_id string, opened bigint, latest bigint, n_readings bigint, closed boolean"


class _Runs(StatefulProcessor):
    """Per system: readings that wait, by time in microseconds, and the open run."""

    def __init__(self, min_micros: int):
        self.min_micros = min_micros

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", _STATE)

    def close(self) -> None:
        pass

    def _load(self):
        if not self.state.exists():
            return {}, None
        at, kind, seen, id_, opened, latest, readings = self.state.get()
        return dict(zip(at, zip(kind, seen, id_))), None if readings is None else (opened, latest, readings)

    def _save(self, waiting: dict, run) -> None:
        parts = [list(x) for x in zip(*waiting.values())] if waiting else [[], [], []]
        self.state.update((list(waiting), *parts, *(run or (None, None, None))))
        if waiting:
            self.handle.registerTimer(-(-min(waiting) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            return iter(())
        waiting, run = self._load()
        for part in rows:
            for at, kind, seen, id_ in zip(*(part[c].tolist() for c in ("at", "kind", "seen", "id"))):
                if at not in waiting or (seen, id_) > waiting[at][1:]:
                    waiting[at] = (kind, seen, id_)
        self._save(waiting, run)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, run = self._load()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        out, changed = [], False
        for at in sorted(t for t in waiting if t <= passed):
            kind = waiting.pop(at)[0]
            if kind == BAD:
                run = (at, at, 1) if run is None else (run[0], at, run[2] + 1)
                changed = True
            elif kind == GOOD and run is not None:
                out.append((*run, True))
                run = None
        if run is not None and changed:
            out.append((*run, False))
        self._save(waiting, run)
        lasting = [(key[0], *r) for r in out if r[1] - r[0] > self.min_micros]
        if lasting:
            yield pd.DataFrame(lasting, columns=["system_id", "opened", "latest", "n_readings", "closed"])


def _micros(column: str):
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{column}`)")


def stream_episodes(
    telemetry: DataFrame,
    gc: GridCode = ENGINE,
    watermark: str = "1 hour",
    min_minutes: float = LIMITS.sustained_minutes,
) -> DataFrame:
    """system_id, run_start, run_end, n_readings, closed: runs of violations longer than the limit.

    An open run appears each time it has grown, with closed false; latest_episodes keeps its last
    row. A reading later than the watermark is not taken. Readings without a system or time
    belong to no series, those without a voltage neither start nor end a run.
    """
    rows = null_if_nan(telemetry, MEASURES)
    at = _micros("timestamp")
    kind = F.when(F.col("voltage_v").isNull(), MISSING).when(breaks(voltage_normal(gc), gc), BAD).otherwise(GOOD)
    low = F.lit(-(2**63)).cast("bigint")
    keyed = rows.select(
        "system_id",
        at.alias("at"),
        kind.cast("int").alias("kind"),
        F.coalesce(_micros("ingestion_timestamp"), low).alias("seen"),
        (F.coalesce(F.col("reading_id").cast("bigint"), low) if "reading_id" in rows.columns else low).alias("id"),
        # The watermark follows the wall clock of the readings, whatever the session's zone.
        F.timestamp_micros(at).alias("event_time"),
    ).withWatermark("event_time", watermark)
    found = (
        # Rows without a system go on to the operator: a filter here would be pushed below the
        # watermark, which all readings must move.
        keyed.where(F.col("at").isNotNull())
        .groupBy("system_id")
        .transformWithStateInPandas(_Runs(int(min_minutes * 60_000_000)), _OUTPUT, "Append", "EventTime")
    )
    back = lambda c: F.expr(f"timestampadd(MICROSECOND, {c}, timestamp_ntz'1970-01-01 00:00:00')")
    return found.select("system_id", back("opened").alias("run_start"), back("latest").alias("run_end"), "n_readings", "closed")


def start_episodes(episodes: DataFrame, output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet table; restarts from its checkpoint without repeats.

    The state is in RocksDB, which keyed state with timers needs; the setting holds for this query.
    """
    conf, name = episodes.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKSDB)
    try:
        writer = episodes.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def latest_episodes(spark: SparkSession, output: str, schema: T.StructType) -> DataFrame:
    """One row per run: its last state."""
    rows = spark.read.schema(schema).parquet(output)
    last = F.max(F.struct("n_readings", "closed", "run_end")).alias("_last")
    return rows.groupBy("system_id", "run_start").agg(last).select(
        "system_id", "run_start", "_last.run_end", "_last.n_readings", "_last.closed"
    )
