"""Staging: projection, key cleaning, dedup, calendar, derived share, flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwatt.functions.scalars import null_if_nan, ratio
from fleetwatt.functions.wallclock import month_start, ntz
from fleetwatt.operators.merge import merge_sources
from fleetwatt.schema import KEYS, MEASURES, RAW_COLUMNS

# Columns beside the raw ones that staging passes on when they are there.
EXTRA = ["reading_id", "utility"]
NEWEST_FIRST = ["ingestion_timestamp", "reading_id"]


def project_raw(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The raw columns, plus the named extra ones, with NaN as NULL."""
    return null_if_nan(df, MEASURES).select(*RAW_COLUMNS, *(extra or []))


def clean_keys(df: DataFrame, start: str | None = None) -> DataFrame:
    """Drop rows without a key and, with a start, those before it; reaches the Parquet scan."""
    keyed = df.where(F.col("system_id").isNotNull() & F.col("timestamp").isNotNull())
    return keyed if start is None else keyed.where(F.col("timestamp") >= ntz(start))


def dedup_latest(
    df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None
) -> DataFrame:
    """Keep the row with the greatest order columns per key.

    Spark ranks before and after the shuffle, so a key with very many copies
    leaves each input task as a single row.
    """
    keys = keys or KEYS
    order = order or [c for c in NEWEST_FIRST if c in df.columns]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"date": F.to_date("timestamp"), "hour_of_day": F.hour("timestamp")}
    )


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", month_start(F.to_date("timestamp")))


def self_consumption(df: DataFrame) -> DataFrame:
    """Share of the solar output used on site, NULL without output."""
    solar = F.col("solar_production_kw")
    return df.withColumn(
        "self_consumption_rate_pct",
        F.when(solar > 0, ratio(solar - F.col("grid_export_kw"), solar) * 100.0),
    )


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def quality_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "voltage_missing_flag": _flag(F.col("voltage_v").isNull()),
            "frequency_missing_flag": _flag(F.col("frequency_hz").isNull()),
            "solar_negative_flag": _flag(F.col("solar_production_kw") < 0),
        }
    )


def _derived(rows: DataFrame) -> DataFrame:
    return quality_flags(self_consumption(with_calendar(rows)))


def stage(df: DataFrame, start: str | None = None) -> DataFrame:
    """The whole staging model; one shuffle, on (system, timestamp)."""
    extra = [c for c in EXTRA if c in df.columns]
    return _derived(dedup_latest(clean_keys(project_raw(df, extra), start)))


def stage_sources(sources: dict[str, DataFrame], start: str | None = None) -> DataFrame:
    """Staging over several sources, the most trusted first.

    A source may lack columns. Each is deduplicated by itself; per system and
    time every column then comes from the first source that has a value.
    """
    wanted = [*RAW_COLUMNS, *EXTRA]
    clean = {
        name: dedup_latest(
            clean_keys(null_if_nan(df, MEASURES).select(*[c for c in wanted if c in df.columns]), start)
        )
        for name, df in sources.items()
    }
    return _derived(merge_sources(clean))
