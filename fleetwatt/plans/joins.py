"""Joining results that belong to the same groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Staging leaves no NULL in these, so joins on them can be plain and keep the
# partitioning of the aggregates. Other group keys, such as the utility, may be
# NULL, and NULL is a group of its own.
NEVER_NULL = {"system_id", "month", "date"}


def join_groups(left: DataFrame, right: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """Add the columns of a table with one row per group."""
    if not by:
        row = right.select(F.struct(*right.columns)).scalar()
        return left.withColumn("_row", row).select("*", "_row.*").drop("_row")
    plain = [c for c in by if c in NEVER_NULL or c.startswith("_")]
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in by})
    match = [
        F.col(c) == F.col(f"_right_{c}") if c in plain else F.col(c).eqNullSafe(F.col(f"_right_{c}"))
        for c in by
    ]
    return left.join(renamed, match, how).drop(*[f"_right_{c}" for c in by])
