"""Data quality: completeness, limits, freshness, conformance, expectations."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql import types as T

from fleetwatt.config import LIMITS, PlantLimits
from fleetwatt.functions.scalars import count_rows, ratio, share_pct
from fleetwatt.functions.wallclock import ntz, seconds_between
from fleetwatt.schema import TELEMETRY_SCHEMA


class QualityGateError(ValueError):
    """A day of telemetry did not pass the quality gate."""


def ingest_stats(df: DataFrame, digits: tuple[int, int, int] = (2, 2, 3)) -> DataFrame:
    solar, volts, hertz = digits
    return df.agg(
        count_rows().alias("total_records"),
        F.round(F.avg("solar_production_kw"), solar).alias("avg_solar_kw"),
        F.round(F.avg("voltage_v"), volts).alias("avg_voltage_v"),
        F.round(F.avg("frequency_hz"), hertz).alias("avg_frequency_hz"),
    )


def _unpivot(one_row: DataFrame, label: str, rows: dict[str, list[Column]], names: list[str]):
    """One output row per entry, from the columns of a one-row aggregate."""
    entries = F.array(
        *[
            F.struct(F.lit(key).alias(label), *[c.alias(n) for n, c in zip(names, columns)])
            for key, columns in rows.items()
        ]
    )
    return one_row.select(F.inline(entries))


def conformance(df: DataFrame, expected: T.StructType = TELEMETRY_SCHEMA) -> DataFrame:
    """Per expected column: is it there, which rows are null or do not cast.

    One aggregate over the table, whatever the number of columns.
    """
    aggregates, rows = [count_rows().alias("_rows")], {}
    for field in expected:
        present = field.name in df.columns
        value = F.col(field.name) if present else F.lit(None).cast("string")
        cast = value.try_cast(field.dataType)
        uncast = F.count_if(cast.isNull() & value.isNotNull())
        nulls = F.count_if(value.isNull())
        aggregates += [uncast.alias(f"_u_{field.name}"), nulls.alias(f"_n_{field.name}")]
        bad_cast, missing = F.col(f"_u_{field.name}"), F.col(f"_n_{field.name}")
        conforms = F.lit(present) & (bad_cast == 0)
        if not field.nullable:
            conforms = conforms & (missing == 0)
        rows[field.name] = [
            F.lit(field.dataType.simpleString()),
            F.lit(present),
            F.col("_rows"),
            bad_cast,
            missing,
            conforms,
        ]
    names = ["expected_type", "is_present", "n_rows", "uncastable_rows", "null_rows", "conforms"]
    return _unpivot(df.agg(*aggregates), "column_name", rows, names)


def missing_cells(columns: list[str]) -> Column:
    """NULL cells over all columns: counted per row, so that one sum is kept."""
    in_row = reduce(add, [F.col(c).isNull().cast("int") for c in columns])
    return F.coalesce(F.sum(in_row), F.lit(0))


def completeness_pct(missing: Column, rows: Column, n_columns: int) -> Column:
    return (F.lit(1.0) - ratio(missing, rows * F.lit(n_columns))) * 100.0


def cell_completeness(df: DataFrame, by=(), columns: list[str] | None = None) -> DataFrame:
    """Missing cells over all columns, in one aggregate."""
    columns = columns or df.columns
    return (
        df.groupBy(*by)
        .agg(count_rows().alias("total_rows"), missing_cells(columns).alias("missing_cells"))
        .withColumn(
            "completeness_pct",
            completeness_pct(F.col("missing_cells"), F.col("total_rows"), len(columns)),
        )
    )


def _systems_pct(expected: int) -> Column:
    return share_pct(F.col("actual_systems"), F.lit(float(expected)))


def system_completeness(
    df: DataFrame,
    expected: int = LIMITS.expected_systems,
    min_pct: float = LIMITS.completeness_min_pct,
) -> DataFrame:
    return (
        df.agg(F.count_distinct("system_id").alias("actual_systems"))
        .withColumn("completeness_pct", _systems_pct(expected))
        .withColumn("passed", F.col("completeness_pct") >= min_pct)
    )


def _unphysical(limits: PlantLimits) -> Column:
    volts = F.col("voltage_v")
    return (volts < limits.physical_voltage_low_v) | (volts > limits.physical_voltage_high_v)


def invalid_voltage(df: DataFrame, limits: PlantLimits = LIMITS) -> DataFrame:
    return df.agg(F.count_if(_unphysical(limits)).alias("invalid_voltage_records"))


def _now(as_of: str | datetime | None) -> Column:
    return F.localtimestamp() if as_of is None else ntz(as_of)


def freshness(
    df: DataFrame,
    as_of: str | datetime | None = None,
    max_hours: float = LIMITS.freshness_max_hours,
) -> DataFrame:
    age = seconds_between(F.col("latest_timestamp"), _now(as_of)) / F.lit(3600.0)
    return (
        df.agg(F.max("timestamp").alias("latest_timestamp"))
        .withColumn("data_age_hours", age)
        .withColumn("passed", F.col("data_age_hours") <= max_hours)
    )


def quality_gate(
    df: DataFrame,
    as_of: str | datetime | None = None,
    expected: int = LIMITS.expected_systems,
    limits: PlantLimits = LIMITS,
) -> DataFrame:
    """The gate's record. Systems are counted after one row per system is left.

    Two mergeable aggregates in a row instead of a distinct count beside them.
    """
    per_system = df.groupBy("system_id").agg(
        F.count_if(_unphysical(limits)).alias("_invalid"), F.max("timestamp").alias("_latest")
    )
    facts = per_system.agg(
        F.count("system_id").alias("actual_systems"),
        F.coalesce(F.sum("_invalid"), F.lit(0)).alias("invalid_voltage_records"),
        F.max("_latest").alias("latest_timestamp"),
    )
    return _judged(facts, as_of, expected, limits)


def _judged(facts: DataFrame, as_of, expected: int, limits: PlantLimits) -> DataFrame:
    age = seconds_between(F.col("latest_timestamp"), _now(as_of)) / F.lit(3600.0)
    return (
        facts.withColumns({"completeness_pct": _systems_pct(expected), "data_age_hours": age})
        .withColumns(
            {
                "completeness_passed": F.col("completeness_pct") >= limits.completeness_min_pct,
                "freshness_passed": F.coalesce(
                    F.col("data_age_hours") <= limits.freshness_max_hours, F.lit(False)
                ),
                # Only a warning: it does not fail the gate.
                "voltage_passed": F.col("invalid_voltage_records") == 0,
            }
        )
        .withColumn("gate_passed", F.col("completeness_passed") & F.col("freshness_passed"))
    )


def observe_gate(df: DataFrame, start: str | None = None, limits: PlantLimits = LIMITS) -> tuple[DataFrame, Observation]:
    """Readings whose next pass also takes what the gate asks of them.

    A task may run more than once and then counts more than once, so only what repeats cannot change
    is used later: a largest time, and whether a count is zero.
    """
    unstaged = F.col("timestamp").isNull() if start is None else F.coalesce(F.col("timestamp") < ntz(start), F.lit(True))
    seen = Observation()
    metrics = [
        F.count_if(_unphysical(limits)).alias("invalid"),
        F.count_if(F.col("system_id").isNotNull() & unstaged).alias("unstaged"),
        F.max("timestamp").alias("latest"),
    ]
    return df.observe(seen, *metrics), seen


def observed_gate(
    df: DataFrame, staged: DataFrame, seen: dict, as_of: str | datetime | None = None,
    expected: int = LIMITS.expected_systems, limits: PlantLimits = LIMITS,
) -> DataFrame:
    """The gate's record from the pass that staged the readings, equal to quality_gate(df).

    Without invalid voltages, and with every system's rows among the staged ones, df is not read again:
    the systems are counted in the staged table. Otherwise the counts are taken from df.
    """
    if seen.get("invalid") != 0 or seen.get("unstaged") != 0:
        return quality_gate(df, as_of, expected, limits)
    latest = F.lit(None).cast("timestamp_ntz") if seen["latest"] is None else ntz(seen["latest"])
    facts = staged.groupBy("system_id").agg(F.lit(0)).agg(F.count("system_id").alias("actual_systems")).withColumns(
        {"invalid_voltage_records": F.lit(0).cast("bigint"), "latest_timestamp": latest}
    )
    return _judged(facts, as_of, expected, limits)


def assert_gate(gate: DataFrame) -> dict:
    """Stop a pipeline on a failed gate; gives the one-row record otherwise."""
    record = gate.first().asDict()
    if not record["completeness_passed"]:
        raise QualityGateError(f"only {record['completeness_pct']:.1f} % of systems reported")
    if not record["freshness_passed"]:
        raise QualityGateError(f"newest reading is {record['data_age_hours']} hours old")
    return record


def _row_checks(not_null, accepted, ranges) -> dict[str, Column]:
    """True where a row fails; NULL counts as no failure but for not_null."""
    checks: dict[str, Column] = {}
    for c in not_null:
        checks[f"not_null_{c}"] = F.col(c).isNull()
    for c, values in accepted.items():
        checks[f"accepted_values_{c}"] = ~F.col(c).isin(values)
    for c, (low, high) in ranges.items():
        checks[f"range_{c}"] = ~F.col(c).between(low, high)
    return checks


def tag_failures(
    df: DataFrame,
    not_null: list[str],
    unique_key: list[str],
    accepted: dict[str, list[str]],
    ranges: dict[str, tuple[float, float]],
    order: list[str],
) -> DataFrame:
    """Adds failed_checks, the names of the expectations a row fails, and row_status.

    Of the rows of a key, all but the first by `order` fail the unique expectation, so the counts
    are those of `expectations`. A key may hold any share of the rows: a hash aggregate finds the
    first row of each key that occurs twice, and rows that come after it are told by a join, which
    adaptive execution splits. Rows without a whole key are no duplicates. All rows and columns
    stay; of rows that are equal in `order` too, none is told apart, so order must tell rows apart.
    """
    keyed = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in unique_key])
    place = F.struct(*[F.col(c) for c in order])
    first = (
        df.where(keyed)
        .groupBy(*[F.col(c).alias(f"_{c}") for c in unique_key])
        .agg(F.min(place).alias("_first"), count_rows().alias("_copies"))
        .where("_copies > 1")
        .drop("_copies")
    )
    on = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"_{c}") for c in unique_key])
    joined = df.join(first, on, "left")
    checks = _row_checks(not_null, accepted, ranges)
    checks[f"unique_{'_'.join(unique_key)}"] = place != F.col("_first")
    names = F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()])
    return joined.withColumn("failed_checks", F.array_compact(names)).withColumn(
        "row_status", F.when(F.size("failed_checks") > 0, "failing").otherwise("good")
    ).select(*df.columns, "failed_checks", "row_status")


def set_aside(tagged: DataFrame, path: str) -> DataFrame:
    """Write tagged rows in one pass, good and failing ones in partitions of one table; gives it back."""
    tagged.write.mode("overwrite").partitionBy("row_status").parquet(path)
    return tagged.sparkSession.read.schema(tagged.schema).parquet(path)


def expectations(
    df: DataFrame,
    not_null: list[str],
    unique_key: list[str],
    accepted: dict[str, list[str]],
    ranges: dict[str, tuple[float, float]],
) -> DataFrame:
    """One row per expectation with the number of rows that fail it."""
    checks = _row_checks(not_null, accepted, ranges)
    counted = df.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    keyed = df.dropna(subset=unique_key)  # a missing key is what not_null is for
    duplicates = (
        keyed.groupBy(*unique_key)
        .agg(count_rows().alias("_copies"))
        .agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("_dup"))
    )
    unique = {f"unique_{'_'.join(unique_key)}": [F.col("_dup")]}
    names, label = ["failed_rows"], "expectation"
    per_row = _unpivot(counted, label, {n: [F.col(n)] for n in checks}, names)
    return per_row.unionByName(_unpivot(duplicates, label, unique, names)).withColumn(
        "passed", F.col("failed_rows") == 0
    )
