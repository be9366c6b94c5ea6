"""Threshold profiles and plant constants, passed to operators as arguments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class GridCode:
    """Limits of one grid-code profile. All limits are doubles, never decimals."""

    name: str
    voltage_nominal_v: float
    voltage_min_v: float
    voltage_max_v: float
    frequency_nominal_hz: float
    frequency_min_hz: float
    frequency_max_hz: float
    voltage_trip_v: float | None = None
    frequency_trip_low_hz: float | None = None
    frequency_trip_high_hz: float | None = None
    power_factor_min: float = 0.95
    # Power factor is only judged above this output; None judges every row.
    power_factor_min_solar_kw: float | None = None
    voltage_severe_ratio: float = 0.10
    voltage_moderate_ratio: float = 0.08
    # A missing reading counts against compliance when True.
    missing_is_violation: bool = False


# The three limit profiles, which disagree on purpose.
ENGINE = GridCode(
    name="engine",
    voltage_nominal_v=240.0,
    voltage_min_v=216.0,
    voltage_max_v=264.0,
    frequency_nominal_hz=60.0,
    frequency_min_hz=59.3,
    frequency_max_hz=60.5,
    voltage_trip_v=211.2,
    frequency_trip_low_hz=57.0,
    frequency_trip_high_hz=61.2,
    missing_is_violation=True,
)
JOB = GridCode(
    name="job",
    voltage_nominal_v=240.0,
    voltage_min_v=240.0 * 0.92,
    voltage_max_v=240.0 * 1.08,
    frequency_nominal_hz=60.0,
    frequency_min_hz=60.0 - 0.3,
    frequency_max_hz=60.0 + 0.3,
)
MART = GridCode(
    name="mart",
    voltage_nominal_v=240.0,
    voltage_min_v=240.0 * (1 - 8.0 / 100.0),
    voltage_max_v=240.0 * (1 + 8.0 / 100.0),
    frequency_nominal_hz=60.0,
    frequency_min_hz=60.0 - 0.3,
    frequency_max_hz=60.0 + 0.3,
    power_factor_min_solar_kw=1.0,
)
PROFILES = {p.name: p for p in (ENGINE, JOB, MART)}


@dataclass(frozen=True)
class PlantLimits:
    """Battery, inverter, tariff and data-quality constants."""

    # Fixed values.
    soh_warning_pct: float = 85.0
    soh_critical_pct: float = 70.0
    calendar_fade_pct_per_year: float = 2.0
    cycle_fade_pct: float = 10.0
    warranty_cycles: float = 4000.0
    capacity_fade_max_pct_per_year: float = 2.5
    battery_capacity_kwh: float = 13.5
    rated_capacity_kw: float = 8.5
    rte_expected_pct: float = 92.0
    rte_low_pct: float = 90.0
    inverter_efficiency_min_pct: float = 96.0
    inverter_efficiency_excellent_pct: float = 97.0
    inverter_temp_max_c: float = 65.0
    inverter_temp_hot_c: float = 60.0
    temp_eff_corr_max: float = -0.4
    thd_voltage_max_pct: float = 5.0
    thd_current_max_pct: float = 8.0
    flex_first_hour: int = 16
    flex_last_hour: int = 21
    flex_first_month: int = 6
    flex_last_month: int = 9
    flex_significant_pct: float = 10.0
    rule_violation_rate_max_pct: float = 2.0
    export_credit_usd_per_kwh: float = 0.075
    settlement_usd_per_kwh: float = 2.0
    baseline_days: int = 10
    expected_systems: int = 500
    completeness_min_pct: float = 95.0
    freshness_max_hours: float = 24.0
    physical_voltage_low_v: float = 200.0
    physical_voltage_high_v: float = 280.0
    max_missing_hours: float = 2.0
    disconnect_hz: float = 0.5
    sustained_minutes: float = 5.0
    expected_step_minutes: int = 5


LIMITS = PlantLimits()
DEFAULT_START = "2024-01-01 00:00:00"
