"""A join and a quantile that do not put one hot group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetwatt.plans.joins import join_groups

SALT = "_salt"
DEFAULT_SALTS = 32


def salt_rows(df: DataFrame, on: list[str], salts: int = DEFAULT_SALTS) -> DataFrame:
    """Spread the rows of each group over a fixed number of salts."""
    return df.withColumn(SALT, F.pmod(F.xxhash64(*on), F.lit(salts)).cast("int"))


def attach_group(df: DataFrame, groups: DataFrame, by: list[str], salts: int) -> DataFrame:
    """Add the columns of a table with one row per group to salted rows.

    Each group row is copied once per salt, so a hot group is joined by as many
    tasks. The copies are spread evenly; how to join is left to Spark, which broadcasts few groups.
    A table without groups is one row: a scalar subquery, no shuffle.
    """
    if not by:
        return join_groups(df, groups, [])
    copies = groups.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return join_groups(df, copies, [*by, SALT], "inner")


BINS = 1000


def exact_quantile(
    df: DataFrame,
    by: list[str],
    column: str,
    share: float,
    name: str,
    salts: int = DEFAULT_SALTS,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact quantile per group, with linear interpolation between ranks.

    The built-in exact percentile holds every distinct value of a group in one
    buffer. Here equal values are counted first. A bounded sketch brackets the
    wanted rank, the bracket is cut into bins of equal width, and exact counts
    per bin find the one with the rank. Only its values are sorted: of a large
    group about one in a million. A poor sketch makes that bin larger but never
    the result wrong, because bins follow the order of the values.
    """
    value = F.col(column)
    known = df.where(value.isNotNull())
    counts = known.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    margin = 3.0 / accuracy
    ends = [max(share - margin, 0.0), min(share + margin, 1.0)]
    bracket = (
        known.groupBy(*by)
        .agg(F.percentile_approx(column, ends, accuracy).alias("_ends"))
        .select(*by, F.col("_ends")[0].alias("_low"), F.col("_ends")[1].alias("_high"))
    )
    low, high = F.col("_low"), F.col("_high")
    place = F.floor(F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0)) * BINS)
    bin_of = (
        F.when(value < low, F.lit(0))
        .when(value > high, F.lit(BINS + 1))
        .otherwise(F.least(place, F.lit(BINS - 1)) + 1)
    ).cast("int")
    binned = attach_group(salt_rows(counts, [column], salts), bracket, by, salts).select(
        *by, SALT, column, "_n", bin_of.alias("_bin")
    )

    # At most BINS + 2 rows per group from here to the target.
    order = Window.partitionBy(*by).orderBy("_bin")
    whole = Window.partitionBy(*by)
    rank = (F.col("_total") - 1) * F.lit(share)
    target = (
        binned.groupBy(*by, "_bin")
        .agg(F.sum("_n").alias("_in_bin"))
        .withColumns(
            {
                "_through": F.sum("_in_bin").over(order),
                "_total": F.sum("_in_bin").over(whole),
            }
        )
        .withColumns(
            {
                "_rank": rank,
                "_before": F.col("_through") - F.col("_in_bin"),
            }
        )
        .where((F.col("_before") <= F.ceil("_rank")) & (F.col("_through") > F.floor("_rank")))
        .groupBy(*by)
        .agg(
            F.min("_bin").alias("_first_bin"),
            F.max("_bin").alias("_last_bin"),
            F.min("_before").alias("_before"),
            F.first("_rank").alias("_rank"),
        )
    )

    # Attached on the same keys as the bracket, so only the target table moves.
    chosen = attach_group(binned, target, by, salts).where(
        F.col("_bin").between(F.col("_first_bin"), F.col("_last_bin"))
    )
    inside = Window.partitionBy(*by).orderBy(column)
    upto = F.col("_before") + F.sum("_n").over(inside)
    ranked = chosen.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_n"))

    def at(position):
        return F.max(
            F.when((F.col("_from") <= position) & (position < F.col("_upto")), value)
        )

    return (
        ranked.groupBy(*by)
        .agg(
            at(F.floor("_rank")).alias("_low"),
            at(F.ceil("_rank")).alias("_high"),
            F.first("_rank").alias("_rank"),
        )
        .select(
            *by,
            (
                F.col("_low")
                + (F.col("_high") - F.col("_low")) * (F.col("_rank") - F.floor("_rank"))
            ).alias(name),
        )
    )
