"""Series operators that split one long series over many tasks.

A window over a whole series would sort all readings of a system in one task.
Here the series is cut into blocks of days. Windows run inside a block, and a
small table with one row per series and block carries state across the cuts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwatt.functions.wallclock import date_chunk
from fleetwatt.schema import KEYS

CHUNK = "_chunk"


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on the keys and the block; keys that may be NULL match NULL."""
    if set(keys) <= set(KEYS):
        return left.join(right, [*keys, CHUNK])
    named = right.withColumnsRenamed({c: f"_right_{c}" for c in [*keys, CHUNK]})
    match = [F.col(c) == F.col(f"_right_{c}") if c in [*KEYS, CHUNK] else F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in [*keys, CHUNK]]
    return left.join(named, reduce(lambda a, b: a & b, match)).drop(*[f"_right_{c}" for c in [*keys, CHUNK]])

DEFAULT_CHUNK_DAYS = 7


def with_chunk(df: DataFrame, keys: list[str], time: str, days: int) -> DataFrame:
    """Number the blocks. Rows without a system or a time belong to no series; another key may
    be NULL, and its rows are a group of their own.

    Saying so here keeps the filters of all branches equal, and so lets Spark
    reuse one exchange for them.
    """
    present = [F.col(c).isNotNull() for c in [*[k for k in keys if k in KEYS], CHUNK]]
    numbered = df.withColumn(CHUNK, date_chunk(F.to_date(time), days))
    return numbered.where(reduce(lambda a, b: a & b, present))


def with_previous(
    df: DataFrame,
    columns: list[str],
    keys: list[str],
    time: str = "timestamp",
    chunk_days: int = DEFAULT_CHUNK_DAYS,
) -> DataFrame:
    """Add previous_<column>: the values of the row before, in its series.

    All are NULL on the first row of a series. Select the columns you need
    before the call: both branches below then share one exchange.
    """
    block = Window.partitionBy(*keys, CHUNK).orderBy(time)
    rows = with_chunk(df, keys, time, chunk_days)
    inside = {f"_before_{c}": F.lag(c).over(block) for c in columns}
    # A constant lag is NULL only where there is no row before.
    opens, closes = F.lag(F.lit(True)).over(block).isNull(), F.lead(F.lit(True)).over(block).isNull()

    series = Window.partitionBy(*keys).orderBy(CHUNK)
    ends = rows.withColumn("_closes", closes).where("_closes").select(*keys, CHUNK, *columns)
    carried = ends.select(
        *keys, CHUNK, *[F.lag(c).over(series).alias(f"_carried_{c}") for c in columns]
    )
    joined = _same(rows.withColumns({**inside, "_opens": opens}), carried, keys)
    previous = [
        F.when(F.col("_opens"), F.col(f"_carried_{c}"))
        .otherwise(F.col(f"_before_{c}"))
        .alias(f"previous_{c}")
        for c in columns
    ]
    return joined.select(*df.columns, *previous)


def runs(
    df: DataFrame,
    holds: Column,
    keys: list[str],
    time: str = "timestamp",
    chunk_days: int = DEFAULT_CHUNK_DAYS,
) -> DataFrame:
    """Maximal runs of consecutive rows for which the condition holds.

    One row per run: keys, run_start, run_end, n_readings. NULL breaks a run.
    """
    block = Window.partitionBy(*keys, CHUNK).orderBy(time)
    flagged = with_chunk(
        df.select(*keys, time, F.coalesce(holds, F.lit(False)).alias("_on")), keys, time, chunk_days
    )
    starts = flagged.withColumn(
        "_starts", F.col("_on") & ~F.lag("_on", 1, False).over(block)
    ).withColumn("_run", F.sum(F.col("_starts").cast("int")).over(block))

    # Pieces of runs inside one block; the grouping keeps the block's partitioning.
    pieces = starts.where("_on").groupBy(*keys, CHUNK, "_run").agg(
        F.min(time).alias("_start"), F.max(time).alias("_end"), F.count(F.lit(1)).alias("_n")
    )
    blocks = starts.groupBy(*keys, CHUNK).agg(
        F.min_by("_on", time).alias("_first"),
        F.max_by("_on", time).alias("_final"),
        F.max("_run").alias("_runs"),
    )
    series = Window.partitionBy(*keys).orderBy(CHUNK)
    through_now = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (
        blocks.withColumn(
            "_joined", (F.col("_first") & F.lag("_final", 1, False).over(series)).cast("int")
        )
        # Run numbers continue over the blocks; a run cut in two counts once.
        .withColumn(
            "_offset",
            F.sum(F.col("_runs") - F.col("_joined")).over(through_now) - F.col("_runs"),
        )
        .select(*keys, CHUNK, "_offset")
    )
    return (
        _same(pieces, offsets, keys)
        .withColumn("_run", F.col("_run") + F.col("_offset"))
        .groupBy(*keys, "_run")
        .agg(
            F.min("_start").alias("run_start"),
            F.max("_end").alias("run_end"),
            F.sum("_n").alias("n_readings"),
        )
        .drop("_run")
    )
