"""Time-series jobs: missing readings, gaps, daily completeness, episodes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from fleetwatt.config import ENGINE, LIMITS, GridCode
from fleetwatt.functions.scalars import count_rows, share_pct
from fleetwatt.functions.wallclock import ntz, seconds_between
from fleetwatt.operators.compliance import BY_SYSTEM
from fleetwatt.operators.violations import breaks, voltage_normal
from fleetwatt.plans.chunks import runs, with_previous


def _seconds(start: str | datetime, end: str | datetime) -> int:
    parse = lambda v: v if isinstance(v, datetime) else datetime.fromisoformat(v)
    return int((parse(end) - parse(start)).total_seconds())


def _span(df: DataFrame, start, end):
    """The given range; what is not given is the table's own first or last time (of no readings, any)."""
    if start is None or end is None:
        own = df.where(F.col("system_id").isNotNull()).agg(F.min("timestamp"), F.max("timestamp")).first()
        start, end = own[0] if start is None else start, own[1] if end is None else end
        start, end = start or end or datetime(2000, 1, 1), end or start or datetime(2000, 1, 1)
    return start, end


def _slot_blocks(df, start, end, step_minutes, slots_per_block):
    """Per system and block of slots: the block's size and the slots present.

    The expected grid is made per block, not per slot, so what moves between
    executors is one short array per system and block. The systems come from the same aggregate:
    readings off the grid or out of the range are in a block -1.
    """
    step = step_minutes * 60
    slots = _seconds(start, end) // step + 1
    last_block = (slots - 1) // slots_per_block
    offset = seconds_between(ntz(start), F.col("timestamp"))
    slot = (offset / F.lit(step)).cast("long")
    in_range = F.col("timestamp").between(ntz(start), ntz(end))
    on_grid = slot.cast("double") * step == offset
    block = F.when(in_range & on_grid, F.floor(slot / F.lit(slots_per_block)).cast("int")).otherwise(-1)
    present = (
        df.where(F.col("system_id").isNotNull())
        .select("system_id", block.alias("_block"), (slot % slots_per_block).cast("int").alias("_slot"))
        .groupBy("system_id", "_block")
        .agg(F.collect_set(F.when(F.col("_block") >= 0, F.col("_slot"))).alias("_present"))
    )
    grid = (
        present.groupBy("system_id")
        .agg(F.lit(0).alias("_"))
        .select("system_id", F.explode(F.sequence(F.lit(0), F.lit(last_block))).alias("_block"))
    )
    first = F.col("_block") * slots_per_block
    size = F.least(F.lit(slots_per_block), F.lit(slots) - first).cast("int")
    return grid.join(present, ["system_id", "_block"], "left").select(
        "system_id",
        first.alias("_first"),
        size.alias("_size"),
        F.coalesce("_present", F.array().cast("array<int>")).alias("_present"),
    )


def missing_readings(
    df: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    step_minutes: int = LIMITS.expected_step_minutes,
    slots_per_block: int = 288,
) -> DataFrame:
    """Expected slots, per system, at which no reading was stored.

    Slots lie between start and end, or else the table's first and last time; one aggregate finds these.
    """
    start, end = _span(df, start, end)
    blocks = _slot_blocks(df, start, end, step_minutes, slots_per_block)
    expected = F.sequence(F.lit(0), F.col("_size") - 1)
    slot = F.col("_first") + F.col("_slot")
    return blocks.select(
        "system_id", "_first", F.explode(F.array_except(expected, "_present")).alias("_slot")
    ).select(
        "system_id",
        (ntz(start) + F.make_dt_interval(mins=(slot * step_minutes).cast("int"))).alias("timestamp"),
    )


def missing_counts(
    df: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    step_minutes: int = LIMITS.expected_step_minutes,
    slots_per_block: int = 288,
) -> DataFrame:
    """Expected, present and missing readings per system."""
    start, end = _span(df, start, end)
    blocks = _slot_blocks(df, start, end, step_minutes, slots_per_block)
    return (
        blocks.groupBy("system_id")
        .agg(
            F.sum(F.col("_size").cast("long")).alias("expected_readings"),
            F.sum(F.size("_present").cast("long")).alias("present_readings"),
        )
        .withColumn("missing_readings", F.col("expected_readings") - F.col("present_readings"))
    )


def gaps(
    df: DataFrame, max_hours: float = LIMITS.max_missing_hours, keys=BY_SYSTEM, chunk_days: int = 7
) -> DataFrame:
    """Readings that follow a silence longer than the limit."""
    rows = df.select(*keys, "timestamp")
    hours = seconds_between(F.col("previous_timestamp"), F.col("timestamp")) / F.lit(3600.0)
    return (
        with_previous(rows, ["timestamp"], list(keys), chunk_days=chunk_days)
        .withColumn("gap_hours", hours)
        .where(F.col("gap_hours") > max_hours)
    )


def daily_completeness(
    df: DataFrame, expected_per_day: int, min_pct: float = LIMITS.completeness_min_pct, by=BY_SYSTEM
) -> DataFrame:
    return (
        df.groupBy(*by, "date")
        .agg(count_rows().alias("n_readings"))
        .withColumn("completeness_pct", share_pct(F.col("n_readings"), F.lit(float(expected_per_day))))
        .withColumn("passed", F.col("completeness_pct") >= min_pct)
    )


def sustained_episodes(
    df: DataFrame,
    gc: GridCode = ENGINE,
    min_minutes: float = LIMITS.sustained_minutes,
    keys=BY_SYSTEM,
    chunk_days: int = 7,
) -> DataFrame:
    """Runs of voltage violations that last longer than the limit.

    Only measured readings take part: a missing one neither starts nor ends a run.
    """
    rows = df.where(F.col("voltage_v").isNotNull())
    minutes = seconds_between(F.col("run_start"), F.col("run_end")) / F.lit(60.0)
    return (
        runs(rows, breaks(voltage_normal(gc), gc), list(keys), chunk_days=chunk_days)
        .withColumn("minutes", minutes)
        .where(F.col("minutes") > min_minutes)
    )
