"""Merging the same readings from several sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from fleetwatt.functions.wallclock import seconds_between
from fleetwatt.schema import KEYS


def merge_sources(sources: dict[str, DataFrame], keys: list[str] | None = None) -> DataFrame:
    """Per key, each column from the first source that has a value for it.

    Sources rank in the order given and may have different columns. Each source
    must hold a key once. One mergeable aggregate, no join between sources.
    """
    keys = keys or KEYS
    names = list(sources)
    tagged = [df.withColumn("_rank", F.lit(rank)) for rank, df in enumerate(sources.values())]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    values = [c for c in rows.columns if c not in (*keys, "_rank")]
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in values]
    # The name comes from the rank afterwards: with numbers only, Spark can
    # aggregate by hash instead of sorting all rows.
    best = F.element_at(F.array(*map(F.lit, names)), F.col("_best") + 1)
    return (
        rows.groupBy(*keys)
        .agg(*first, F.count(F.lit(1)).alias("n_sources"), F.min("_rank").alias("_best"))
        .withColumn("best_source", best)
        .drop("_best")
    )


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def asof_match(
    left: DataFrame, right: DataFrame, by: list[str], tolerance_minutes: float, name: str, time: str = "timestamp"
) -> DataFrame:
    """left with a struct `name`: the latest row of right at or before its time, within the tolerance.

    The struct has right's time and values; it is NULL without a match. Rows of both tables are cut
    into time buckets as wide as the tolerance. A match lies in a row's own bucket or is the last row
    of the one before, so one row per bucket is carried on, and a sort within each bucket finds all
    matches: no pairs are made, and a long series is spread over its buckets. right holds a time once
    per group, which may be NULL; rows without a time match nothing.
    """
    width = F.lit(float(tolerance_minutes) * 60.0)
    bucket = F.floor(seconds_between(F.expr(_EPOCH), F.col(time)) / width)
    values = [c for c in right.columns if c not in by]
    there = right.where(F.col(time).isNotNull()).select(*by, F.col(time).alias("_time"), bucket.alias("_bucket"), F.struct(*values).alias(name))
    last = F.max_by(F.struct("_time", name), "_time").alias("_edge")
    carried = there.groupBy(*by, "_bucket").agg(last).select(*by, "_edge._time", (F.col("_bucket") + 1).alias("_bucket"), f"_edge.{name}")
    here = left.withColumns({"_time": F.col(time), "_bucket": bucket, "_asks": F.lit(1)})
    kept = [c for c in left.columns if c not in by]
    rows = here.unionByName(there.unionByName(carried).withColumn("_asks", F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy(*by, "_bucket").orderBy("_time", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_found", F.last(name, ignorenulls=True).over(order)).where("_asks = 1")
    near = seconds_between(F.col(f"_found.{time}"), F.col(time)) <= width
    return found.select(*by, *kept, F.when(near, F.col("_found")).alias(name))


def merge_sources_asof(
    sources: dict[str, DataFrame], tolerance_minutes: float, by: list[str] | None = None, time: str = "timestamp"
) -> DataFrame:
    """Sources whose clocks differ, merged at the times of the first one.

    Each further source gives its latest row within the tolerance. Every column comes from the first
    source, in the order given, that has a value; <name>_age_minutes says how old a source's row is
    (NULL without one), n_sources how many had one.
    """
    by = by or ["system_id"]
    (first, base), *others = sources.items()
    rows = base.withColumns({f"_own_{c}": F.col(c) for c in base.columns if c not in (*by, time)}).select(
        *by, time, *[f"_own_{c}" for c in base.columns if c not in (*by, time)]
    )
    for name, df in others:
        rows = asof_match(rows, df, by, tolerance_minutes, f"_from_{name}", time)
    columns = list(dict.fromkeys(c for df in sources.values() for c in df.columns if c not in (*by, time)))
    origin = {c: [F.col(f"_own_{c}")] * (c in base.columns) + [F.col(f"_from_{n}.{c}") for n, df in others if c in df.columns] for c in columns}
    ages = {n: seconds_between(F.col(f"_from_{n}.{time}"), F.col(time)) / F.lit(60.0) for n, _ in others}
    number = sum((F.col(f"_from_{n}").isNotNull().cast("int") for n, _ in others), F.lit(1))
    return rows.select(
        *by, time, *[F.coalesce(*parts).alias(c) for c, parts in origin.items()], number.alias("n_sources"),
        *[age.alias(f"{n}_age_minutes") for n, age in ages.items()],
    )
