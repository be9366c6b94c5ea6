"""The monthly report: one nested document per group."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from fleetwatt.config import ENGINE, LIMITS, GridCode, PlantLimits
from fleetwatt.functions.scalars import count_rows, in_flex_window, ratio, total
from fleetwatt.functions.wallclock import ntz, whole_days_between
from fleetwatt.operators.battery import health_columns, round_trip_efficiency
from fleetwatt.operators.compliance import flex_reduction, frequency_rate, status_of, voltage_rate
from fleetwatt.operators.energy import energy_columns, period_text, utility_mode
from fleetwatt.operators.inverter import inverter_status
from fleetwatt.operators.quality import completeness_pct, missing_cells
from fleetwatt.operators.staging import with_month
from fleetwatt.operators.violations import breaks, frequency_normal, voltage_normal
from fleetwatt.plans.joins import join_groups
from fleetwatt.schema import RAW_SCHEMA

# Texts and defaults of the report.
REPORT_TYPE = "California NEM 3.0 Monthly Compliance & Performance"
STANDARD = "CPUC Rule 21"
STANDARDS_REFERENCE = "CPUC Rule 21 (2023), IEEE 1547-2018"
NEM_PROGRAM = "NEM 3.0 (effective April 2023)"
DR_PROGRAM = "ELRP (Emergency Load Reduction Program)"
WARRANTY = "10 years or 4,000 cycles, 70% capacity retention"
DEFAULTS = {
    "soh_pct": 100.0,
    "equivalent_cycles": 0.0,
    "cycles_remaining": 4000.0,
    "rte_pct": 93.0,
    "status": "UNKNOWN",
    "eol_years": 10.0,
    "mean_efficiency": 97.0,
    "reduction": 0.0,
    "thd": 0.0,
    "utility": "PGE",
}


def daily_sums(df: DataFrame, keys, columns, gc: GridCode, limits: PlantLimits, step_hours, more=()) -> DataFrame:
    """Everything the report adds up, per group of keys, in one pass; and further aggregates."""
    inside = in_flex_window(F.col("timestamp"), limits)
    load, eff, pf = F.col("grid_import_kw"), F.col("inverter_efficiency_pct"), F.col("power_factor")
    soc = F.col("battery_soc_pct")
    energy = {
        "solar_kwh": "solar_production_kw",
        "consumption_kwh": "consumption_kw",
        "grid_export_kwh": "grid_export_kw",
        "grid_import_kwh": "grid_import_kw",
    }
    return df.groupBy(*keys).agg(
        count_rows().alias("n_readings"),
        F.min("timestamp").alias("period_start"),
        F.max("timestamp").alias("period_end"),
        F.count_if(breaks(voltage_normal(gc), gc)).alias("voltage_violations"),
        F.count_if(breaks(frequency_normal(gc), gc)).alias("frequency_violations"),
        F.sum(pf).alias("pf_sum"),
        F.count(pf).alias("pf_n"),
        F.count_if(inside).alias("flex_readings"),
        F.sum(F.when(inside, load)).alias("flex_sum"),
        F.count(F.when(inside, load)).alias("flex_n"),
        F.sum(F.when(~inside, load)).alias("base_sum"),
        F.count(F.when(~inside, load)).alias("base_n"),
        *[(total(F.col(c)) * step_hours).alias(name) for name, c in energy.items()],
        F.sum(eff).alias("eff_sum"),
        F.count(eff).alias("eff_n"),
        F.count_if(F.col("inverter_temp_c") > limits.inverter_temp_max_c).alias("thermal_events"),
        F.coalesce((F.max(soc) - F.min(soc)) / F.lit(100.0), F.lit(0.0)).alias("equivalent_cycles"),
        missing_cells(columns).alias("missing_cells"),
        *more,
    )


def summed(daily: DataFrame, by) -> DataFrame:
    """Rows per system and date added up per group. Cycles are those of a system: their mean over systems."""
    ends = ("period_start", "period_end")
    parts = [c for c in daily.columns if c not in (*by, "system_id", "date", *ends)]

    def added(rows, keys, cycles):
        return rows.groupBy(*keys).agg(
            F.min("period_start").alias("period_start"),
            F.max("period_end").alias("period_end"),
            *[(cycles if c == "equivalent_cycles" else F.sum)(c).alias(c) for c in parts],
        )

    systems = added(daily, dict.fromkeys([*by, "system_id"]), F.sum)
    return systems if "system_id" in by else added(systems, by, F.avg)


def monthly_report(
    df: DataFrame,
    gc: GridCode = ENGINE,
    by=("system_id", "month"),
    thd: DataFrame | None = None,
    as_of: str | datetime | None = None,
    step_hours: float = 1.0,
    limits: PlantLimits = LIMITS,
) -> DataFrame:
    """Seven blocks per group. Missing parts take the report's defaults.

    Readings are added up once, per group, system and date; the groups are made from
    that. The battery of a group is the mean of its systems' batteries. Completeness is that of
    the raw columns. thd may give thd_voltage_pct and thd_current_pct per group.
    """
    by = list(by)
    columns = [c for c in RAW_SCHEMA.names if c in df.columns]
    rows = with_month(df) if "month" in by and "month" not in df.columns else df
    base = summed(daily_sums(rows, list(dict.fromkeys([*by, "system_id", "date"])), columns, gc, limits, step_hours), by)
    rte = round_trip_efficiency(rows, by, limits).select(*by, "round_trip_efficiency_pct")
    utility = None if "utility" in by else utility_mode(rows, by)
    return assemble(base, by, rte, utility, len(columns), thd, as_of, "utility" in df.columns, limits)


def assemble(
    base: DataFrame,
    by: list[str],
    rte: DataFrame,
    utility: DataFrame | None,
    n_columns: int,
    thd: DataFrame | None = None,
    as_of: str | datetime | None = None,
    has_utility: bool = True,
    limits: PlantLimits = LIMITS,
) -> DataFrame:
    """The report's blocks from sums per group, round trips, and the utility (None: a group key)."""
    base = base.withColumns(
        {
            "days_in_service": whole_days_between(F.col("period_start"), F.col("period_end")),
            "baseline_import_kw": ratio(F.col("base_sum"), F.col("base_n")),
            "flex_import_kw": ratio(F.col("flex_sum"), F.col("flex_n")),
            "mean_efficiency_pct": ratio(F.col("eff_sum"), F.col("eff_n")),
        }
    ).withColumns({**health_columns(limits), **energy_columns(limits)})
    parts = join_groups(base, rte, by)
    if utility is None:
        parts = parts.withColumn("utility_mode", F.col("utility"))
    else:
        parts = join_groups(parts, utility, by)
    if thd is None:
        none = F.lit(None).cast("double")
        parts = parts.withColumns({"thd_voltage_pct": none, "thd_current_pct": none})
    else:
        parts = join_groups(parts, thd.select(*by, "thd_voltage_pct", "thd_current_pct"), by)

    def known(name, key):
        return F.coalesce(F.col(name), F.lit(DEFAULTS[key]))

    reduction = F.coalesce(flex_reduction(), F.lit(DEFAULTS["reduction"]))
    mean_eff = known("mean_efficiency_pct", "mean_efficiency")
    stamp = F.localtimestamp() if as_of is None else ntz(as_of)
    blocks = {
        "report_metadata": {
            "report_type": F.lit(REPORT_TYPE),
            "reporting_period": period_text(F.col("period_start"), F.col("period_end")),
            "utility_territory": F.col("utility_mode") if has_utility else F.lit(DEFAULTS["utility"]),
            "interconnection_standard": F.lit(STANDARD),
            "nem_program": F.lit(NEM_PROGRAM),
            "rated_capacity_kw": F.lit(limits.rated_capacity_kw),
            "battery_capacity_kwh": F.lit(limits.battery_capacity_kwh),
            "generated_timestamp": stamp,
        },
        "compliance": {
            "voltage_range_a_compliance_pct": F.lit(100.0) - voltage_rate(),
            "frequency_normal_range_compliance_pct": F.lit(100.0) - frequency_rate(),
            "power_factor_mean": ratio(F.col("pf_sum"), F.col("pf_n")),
            "thd_voltage_pct": known("thd_voltage_pct", "thd"),
            "thd_current_pct": known("thd_current_pct", "thd"),
            "overall_status": status_of(voltage_rate(), limits),
            "standards_reference": F.lit(STANDARDS_REFERENCE),
        },
        "energy": {
            "total_solar_generation_kwh": F.col("solar_kwh"),
            "total_consumption_kwh": F.col("consumption_kwh"),
            "total_grid_export_kwh": F.col("grid_export_kwh"),
            "total_grid_import_kwh": F.col("grid_import_kwh"),
            "net_energy_kwh": F.col("net_energy_kwh"),
            "self_consumption_rate_pct": F.col("self_consumption_pct"),
            "utility_credits_estimated_usd": F.col("export_credit_usd"),
        },
        "demand_response": {
            "flex_alert_participation": dr_status(reduction),
            "load_reduction_achieved_pct": reduction,
            "program": F.lit(DR_PROGRAM),
        },
        "battery": {
            "state_of_health_pct": known("soh_pct", "soh_pct"),
            "equivalent_cycles": known("equivalent_cycles", "equivalent_cycles"),
            "warranty_cycles_remaining": known("cycles_remaining", "cycles_remaining"),
            "round_trip_efficiency_pct": known("round_trip_efficiency_pct", "rte_pct"),
            "battery_status": known("soh_status", "status"),
            "warranty_status": F.lit(WARRANTY),
            "projected_eol_years": known("eol_years", "eol_years"),
        },
        "inverter": {
            "mean_efficiency_pct": mean_eff,
            "thermal_events": F.col("thermal_events"),
            "inverter_status": inverter_status(mean_eff, limits),
        },
        "data_quality": {
            "total_data_points": F.col("n_readings"),
            "missing_data_points": F.col("missing_cells"),
            "data_completeness_pct": completeness_pct(
                F.col("missing_cells"), F.col("n_readings"), n_columns
            ),
        },
    }
    return parts.select(
        *by,
        *[
            F.struct(*[c.alias(field) for field, c in fields.items()]).alias(block)
            for block, fields in blocks.items()
        ],
    )


def dr_status(reduction):
    """Enabled if there is a reduction other than zero."""
    return F.when(reduction != 0, "Enabled").otherwise("N/A")


def flat(report: DataFrame, by) -> DataFrame:
    """The report's fields side by side, without the time of generation."""
    blocks = [c for c in report.columns if c not in by]
    return report.select(*by, *[f"{b}.*" for b in blocks]).drop("generated_timestamp")
