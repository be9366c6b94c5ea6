"""Daily histograms of a measure that merge over days, and exact quantiles made from them.

A row per group, date and bin holds the number of readings, their sum and the largest one. Rows of
any days add up, so the bin with a wanted rank of any period follows from sums over the state, and
one pass over the readings takes the values of that bin alone. Bins follow the order of the values,
so their width decides how much is read, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwatt.functions.scalars import count_rows, ratio, total
from fleetwatt.functions.wallclock import month_start
from fleetwatt.operators.compliance import BY_SYSTEM
from fleetwatt.plans.joins import join_groups
from fleetwatt.plans.lineage import stored

# A power of two, so that the division is exact. Values beyond the outermost bins belong to these.
WIDTH = 1.0 / 64.0
OUTERMOST = 1 << 14


def bin_of(column: str, width: float = WIDTH) -> Column:
    """Number of the value's bin; NULL has none."""
    place = F.floor(F.greatest(F.least(F.col(column) / F.lit(width), F.lit(float(OUTERMOST))), F.lit(float(-OUTERMOST))))
    return F.when(F.col(column).isNotNull(), place.cast("int"))


def daily_histograms(df: DataFrame, column: str, keys=BY_SYSTEM, width: float = WIDTH) -> DataFrame:
    """Readings of staged rows per group, date and bin; NULLs are counted in a bin of their own (NULL)."""
    return df.groupBy(*keys, "date", bin_of(column, width).alias("bin")).agg(
        count_rows().alias("n"), total(F.col(column)).alias("value_sum"), F.max(column).alias("value_max")
    )


def _months(df: DataFrame, by) -> DataFrame:
    return df.withColumn("month", month_start(F.col("date"))) if "month" in by and "month" not in df.columns else df


def located(histograms: DataFrame, by, share: float) -> DataFrame:
    """Per group: n_readings, mean and maximum, the wanted rank (from 0), and the bins that hold it.

    first_bin and last_bin differ where the rank lies between the last value of one bin and the first
    of the next; before is the number of values below first_bin. Groups without values have no bins.
    """
    rows = _months(histograms, by)
    if "system_id" in by:
        # A system's state is small: sums and ranks share one exchange on the group.
        rows = rows.repartition(*by)
    sums = rows.groupBy(*by, "bin").agg(
        F.sum("n").alias("_n"), F.sum("value_sum").alias("_sum"), F.max("value_max").alias("_max")
    )
    here = F.when(F.col("bin").isNotNull(), F.col("_n")).otherwise(F.lit(0))
    order = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        sums.withColumn("_here", here)
        .withColumns({"_through": F.sum("_here").over(order), "_values": F.sum("_here").over(Window.partitionBy(*by))})
        .withColumns({"_before": F.col("_through") - F.col("_here"), "_rank": (F.col("_values") - 1) * F.lit(share)})
    )
    hit = (F.col("_here") > 0) & (F.col("_before") <= F.ceil("_rank")) & (F.col("_through") > F.floor("_rank"))
    return ranked.groupBy(*by).agg(
        F.sum("_n").alias("n_readings"),
        ratio(F.sum("_sum"), F.sum("_here")).alias("mean"),
        F.max("_max").alias("max"),
        F.max("_rank").alias("rank"),
        F.min(F.when(hit, F.col("bin"))).alias("first_bin"),
        F.max(F.when(hit, F.col("bin"))).alias("last_bin"),
        F.min(F.when(hit, F.col("_before"))).alias("before"),
    )


def summary_of_days(
    histograms: DataFrame, df: DataFrame, column: str, by, share: float, names: dict[str, str],
    width: float = WIDTH,
) -> DataFrame:
    """Count, mean, maximum and exact quantile per group, from histograms and the readings they count.

    by may hold the keys of the histograms, date and month. names gives the columns for mean, max and
    quantile. The place of the rank is stored first, so Spark knows its size when it plans the join:
    one row per group and bin found, at most two a group, with no copies, met by the readings of
    that bin. Those move on as counts per value. A group without values has a count and NULLs.
    """
    by = list(by)
    place = stored(located(histograms, by, share), "located")
    rows = _months(df, by).select(*by, F.col(column).alias("_value"), bin_of(column, width).alias("_bin"))
    # The bins between the two hold no values.
    ends = F.array_distinct(F.array("first_bin", "last_bin"))
    wanted = place.where("first_bin IS NOT NULL").select(*by, F.explode(ends).alias("_bin"))
    inside = join_groups(rows.where("_bin IS NOT NULL"), wanted, [*by, "_bin"], "inner")
    counts = inside.groupBy(*by, "_value").agg(count_rows().alias("_n"))
    # One more row per group carries what is known already.
    known = place.select(*by, F.lit(None).cast("double").alias("_value"), F.lit(0).cast("bigint").alias("_n"), F.struct("n_readings", "mean", "max", "rank", "before").alias("_known"))
    both = counts.withColumn("_known", F.lit(None).cast(known.schema["_known"].dataType)).unionByName(known)
    group = Window.partitionBy(*by)
    upto = F.sum("_n").over(group.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = both.withColumns({"_upto": upto, "_place": F.max("_known").over(group)})
    rank, value = F.col("_place.rank"), F.col("_value")
    end = F.col("_place.before") + F.col("_upto")

    def at(position):
        return F.max(F.when((end - F.col("_n") <= position) & (position < end), value))

    low, high = F.col("_low"), F.col("_high")
    return (
        ranked.groupBy(*by)
        .agg(F.max("_known").alias("_known"), at(F.floor(rank)).alias("_low"), at(F.ceil(rank)).alias("_high"))
        .select(
            *by, "_known.n_readings", F.col("_known.mean").alias(names["mean"]), F.col("_known.max").alias(names["max"]),
            (low + (high - low) * (F.col("_known.rank") - F.floor("_known.rank"))).alias(names["quantile"]),
        )
    )
