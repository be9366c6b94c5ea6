"""The registered queries as plain SQL over the same tables, for cross-checks.

Written apart from the operators: limits are spelled out again, as doubles.
Every text starts from the same common table expressions.
"""

from __future__ import annotations

_TELEMETRY = """
mapped AS (
  SELECT event_id AS id, ts, user_id, value,
    CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CAST((event_id * 7919) % 601 - 300 AS DOUBLE) / 300e0 AS u,
    CAST((event_id * 104729) % 601 - 300 AS DOUBLE) / 300e0 AS w,
    date_trunc('hour', ts) + to_days(CAST((user_id % 12) * 30 - 10 AS INT)) AS mts
  FROM events),
powered AS (
  SELECT *, CASE WHEN id % 97 = 0 THEN -5e-1
      WHEN extract(hour FROM mts) BETWEEN 6 AND 18 THEN least(value, 100e0) / 100e0 * 85e-1
      ELSE 0e0 END AS solar,
    5e-1 + k / 40e0 AS used
  FROM mapped),
heated AS (
  SELECT *, 30e0 + solar * 25e-1 + CAST(id % 50 AS DOUBLE) / 5e0
      + CASE WHEN id % 67 = 0 THEN 30e0 ELSE 0e0 END AS heat
  FROM powered),
telemetry AS (
  SELECT id AS reading_id,
    CASE WHEN id % 211 = 0 THEN NULL
      ELSE 'SYS-' || lpad(CAST(user_id AS VARCHAR), 5, '0') END AS system_id,
    mts AS "timestamp",
    solar AS solar_production_kw,
    used AS consumption_kw,
    greatest(0e0, used - solar) AS grid_import_kw,
    greatest(0e0, solar - used) AS grid_export_kw,
    15e0 + CAST((id * 37) % 81 AS DOUBLE) AS battery_soc_pct,
    CAST((id * 53) % 501 - 250 AS DOUBLE) / 100e0 AS battery_power_kw,
    CASE WHEN id % 101 = 0 THEN NULL WHEN id % 997 = 0 THEN 195e0
      ELSE 240e0 + 32e0 * u * u * u END AS voltage_v,
    CASE WHEN id % 103 = 0 THEN NULL WHEN id % 499 = 0 THEN 565e-1 WHEN id % 503 = 0 THEN 615e-1
      ELSE 60e0 + 8e-1 * w * w * w END AS frequency_hz,
    heat AS inverter_temp_c,
    978e-1 - (heat - 35e0) * 4e-2 + CAST((id * 31) % 13 - 6 AS DOUBLE) / 10e0
      - CASE WHEN id % 41 = 0 THEN 3e0 ELSE 0e0 END AS inverter_efficiency_pct,
    945e-3 + CAST((id * 11) % 56 AS DOUBLE) / 1000e0 AS power_factor,
    CASE user_id % 3 WHEN 0 THEN 'PGE' WHEN 1 THEN 'SCE' ELSE 'SDGE' END AS utility,
    ts AS ingestion_timestamp
  FROM heated)"""

_STAGED = """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY system_id, "timestamp"
      ORDER BY ingestion_timestamp DESC, reading_id DESC) AS rn
  FROM telemetry
  WHERE system_id IS NOT NULL),
stg AS (
  SELECT * EXCLUDE (rn), CAST("timestamp" AS DATE) AS date,
    CAST(extract(hour FROM "timestamp") AS INT) AS hour_of_day,
    CAST(date_trunc('month', "timestamp") AS DATE) AS month
  FROM ranked WHERE rn = 1)"""

_VIOLATIONS = """,
viol AS (
  SELECT system_id, date, "timestamp",
    CASE WHEN voltage_v < 220.8e0 THEN 'VOLTAGE_LOW' ELSE 'VOLTAGE_HIGH' END AS violation_type,
    voltage_v AS measured_value, 220.8e0 AS limit_min, 259.20000000000005e0 AS limit_max,
    abs(voltage_v - 240e0) / 240e0 * 100e0 AS deviation,
    CASE WHEN abs(voltage_v - 240e0) / 240e0 > 10e-2 THEN 'SEVERE'
      WHEN abs(voltage_v - 240e0) / 240e0 > 8e-2 THEN 'MODERATE' END AS severity,
    'CPUC Rule 21 Section 3.2.1' AS regulatory_reference, utility
  FROM stg WHERE voltage_v < 220.8e0 OR voltage_v > 259.20000000000005e0
  UNION ALL
  SELECT system_id, date, "timestamp",
    CASE WHEN frequency_hz < 59.7e0 THEN 'FREQUENCY_LOW' ELSE 'FREQUENCY_HIGH' END,
    frequency_hz, 59.7e0, 60.3e0, abs(frequency_hz - 60e0), 'CRITICAL', 'IEEE 1547-2018 Table 7', utility
  FROM stg WHERE frequency_hz < 59.7e0 OR frequency_hz > 60.3e0
  UNION ALL
  SELECT system_id, date, "timestamp", 'POWER_FACTOR_LOW', power_factor, 95e-2,
    CAST(NULL AS DOUBLE), 95e-2 - power_factor, 'MODERATE', 'IEEE 1547-2018 Section 5.2', utility
  FROM stg WHERE power_factor < 95e-2 AND solar_production_kw > 1e0),
guided AS (
  SELECT *, CASE WHEN violation_type LIKE 'VOLTAGE%' THEN 'Report to utility if sustained >5min per IEEE 1547'
      WHEN violation_type LIKE 'FREQUENCY%' THEN 'Immediate disconnection if >0.5Hz per CAISO tariff'
      WHEN violation_type = 'POWER_FACTOR_LOW' THEN 'Enable reactive power support per CPUC Rule 21'
    END AS action_required
  FROM viol)"""


def _raw(body: str) -> str:
    return f"WITH {_TELEMETRY}\n{body}"


def _stg(body: str) -> str:
    """body may start with further common table expressions (", x AS (...)")."""
    return f"WITH {_TELEMETRY}{_STAGED}\n{body}"


_STARTED = """, started AS (SELECT * FROM stg WHERE "timestamp" >= TIMESTAMP '2024-01-01 00:00:00')"""


def _viol(body: str) -> str:
    return f"WITH {_TELEMETRY}{_STAGED}{_VIOLATIONS}\n{body}"


_RAW_COLUMNS = """system_id, "timestamp", solar_production_kw, consumption_kw, grid_import_kw,
  grid_export_kw, battery_soc_pct, battery_power_kw, voltage_v, frequency_hz, inverter_temp_c,
  inverter_efficiency_pct, power_factor"""
_SELF = """CASE WHEN solar_production_kw > 0
    THEN round((solar_production_kw - grid_export_kw) / solar_production_kw * 100e0, 9) END"""
_FLAGS = """CASE WHEN voltage_v IS NULL THEN 1 ELSE 0 END AS voltage_missing_flag,
  CASE WHEN frequency_hz IS NULL THEN 1 ELSE 0 END AS frequency_missing_flag,
  CASE WHEN solar_production_kw < 0 THEN 1 ELSE 0 END AS solar_negative_flag"""
_MART_COLUMNS = """system_id, date, "timestamp", violation_type, measured_value, limit_min, limit_max,
  round(deviation, 9) AS deviation, severity, regulatory_reference"""

# Engine-profile conditions. A missing reading is a violation there.
_V_BAD = "NOT coalesce(voltage_v BETWEEN 216e0 AND 264e0, false)"
_F_BAD = "NOT coalesce(frequency_hz BETWEEN 59.3e0 AND 60.5e0, false)"
_FLEX = """(extract(hour FROM "timestamp") BETWEEN 16 AND 21 AND extract(month FROM "timestamp") BETWEEN 6 AND 9)"""

ORACLE: dict[str, str] = {}

# --- sources, sinks, schema --------------------------------------------------

ORACLE["a01_typed_scan"] = _raw(f"SELECT {_RAW_COLUMNS} FROM telemetry")
ORACLE["a02_scan"] = _raw("SELECT * FROM telemetry")
ORACLE["a03_day_slice"] = _raw(
    """SELECT *, CAST("timestamp" AS DATE) AS dt FROM telemetry
    WHERE CAST("timestamp" AS DATE) = DATE '2024-06-15'"""
)


def _conformance() -> str:
    types = {"system_id": ("string", "VARCHAR"), "timestamp": ("timestamp_ntz", "TIMESTAMP")}
    doubles = [
        "solar_production_kw", "consumption_kw", "grid_import_kw", "grid_export_kw",
        "battery_soc_pct", "battery_power_kw", "voltage_v", "frequency_hz",
        "inverter_temp_c", "inverter_efficiency_pct", "power_factor",
    ]
    types.update({c: ("double", "DOUBLE") for c in doubles})
    spoil = {"voltage_v": (89, "broken"), "frequency_hz": (83, "n/a"), "timestamp": (79, "yesterday")}
    parts = []
    for name, (label, kind) in types.items():
        text = f'CAST("{name}" AS VARCHAR)'
        if name in spoil:
            text = f"CASE WHEN reading_id % {spoil[name][0]} = 0 THEN '{spoil[name][1]}' ELSE {text} END"
        present = name != "battery_power_kw"
        if not present:
            text = "CAST(NULL AS VARCHAR)"
        bad = f"count(*) FILTER (WHERE v IS NOT NULL AND TRY_CAST(v AS {kind}) IS NULL)"
        nulls = "count(*) FILTER (WHERE v IS NULL)"
        strict = f" AND {nulls} = 0" if name in ("system_id", "timestamp") else ""
        parts.append(
            f"SELECT '{name}' AS column_name, '{label}' AS expected_type, {str(present).lower()} AS is_present, "
            f"count(*) AS n_rows, {bad} AS uncastable_rows, {nulls} AS null_rows, "
            f"({str(present).lower()} AND {bad} = 0{strict}) AS conforms FROM (SELECT {text} AS v FROM telemetry)"
        )
    return " UNION ALL ".join(parts)


ORACLE["a04_conformance"] = _raw(_conformance())
ORACLE["a05_ingest_stamp"] = _raw(
    """SELECT * REPLACE (TIMESTAMP '2024-12-16 00:00:00' AS ingestion_timestamp) FROM telemetry"""
)
ORACLE["a06_write_roundtrip"] = _raw("""SELECT *, CAST("timestamp" AS DATE) AS date FROM telemetry""")
ORACLE["a07_violations_roundtrip"] = _viol(
    f"""SELECT {_MART_COLUMNS}, action_required,
    TIMESTAMP '2024-12-16 00:00:00' AS analysis_timestamp FROM guided"""
)
ORACLE["a08_ingest_stats"] = _raw(
    """SELECT count(*) AS total_records, round(avg(solar_production_kw), 9) AS avg_solar_kw,
    round(avg(voltage_v), 9) AS avg_voltage_v, round(avg(frequency_hz), 9) AS avg_frequency_hz
    FROM telemetry"""
)

ORACLE["a10_named_models"] = _stg(
    "SELECT utility, hour_of_day, count(*) AS n_readings FROM stg GROUP BY utility, hour_of_day"
)
ORACLE["a11_materialized_mart"] = _viol(
    "SELECT violation_type, severity, count(*) AS violation_count FROM viol GROUP BY violation_type, severity"
)

# --- staging and flags -------------------------------------------------------

ORACLE["b01_project"] = _raw(f"SELECT {_RAW_COLUMNS}, ingestion_timestamp FROM telemetry")
ORACLE["b02_clean_keys"] = _raw(
    """SELECT reading_id, system_id, "timestamp" FROM telemetry
    WHERE system_id IS NOT NULL AND "timestamp" IS NOT NULL
      AND "timestamp" >= TIMESTAMP '2024-01-01 00:00:00'"""
)
ORACLE["b03_dedup_latest"] = _stg(
    f'{_STARTED} SELECT reading_id, system_id, "timestamp", ingestion_timestamp FROM started'
)
ORACLE["b04_calendar"] = _raw(
    """SELECT reading_id, "timestamp", CAST("timestamp" AS DATE) AS date,
    CAST(extract(hour FROM "timestamp") AS INT) AS hour_of_day FROM telemetry"""
)
ORACLE["b05_self_consumption"] = _raw(
    f"SELECT reading_id, {_SELF} AS self_consumption_rate_pct FROM telemetry"
)
ORACLE["b06_quality_flags"] = _raw(f"SELECT reading_id, {_FLAGS} FROM telemetry")
ORACLE["b07_staging"] = _stg(
    f"""{_STARTED} SELECT {_RAW_COLUMNS}, ingestion_timestamp, reading_id, utility, date, hour_of_day,
    {_SELF} AS self_consumption_rate_pct, {_FLAGS} FROM started"""
)
ORACLE["b08_voltage_range_flag"] = _stg(
    f'SELECT system_id, "timestamp", voltage_v, NOT ({_V_BAD}) AS voltage_normal FROM stg'
)
ORACLE["b09_voltage_trip_flag"] = _stg(
    """SELECT system_id, "timestamp", voltage_v, coalesce(voltage_v < 211.2e0, false) AS voltage_trip
    FROM stg"""
)
ORACLE["b10_frequency_range_flag"] = _stg(
    f'SELECT system_id, "timestamp", frequency_hz, NOT ({_F_BAD}) AS frequency_normal FROM stg'
)
ORACLE["b11_frequency_trip_flag"] = _stg(
    """SELECT system_id, "timestamp", frequency_hz,
    coalesce(frequency_hz > 61.2e0 OR frequency_hz < 57e0, false) AS frequency_trip FROM stg"""
)
_WIDE = """, wide AS (
  SELECT system_id, "timestamp",
    CASE WHEN voltage_v < 220.8e0 OR voltage_v > 259.20000000000005e0 THEN 'VOLTAGE_DEVIATION' END AS voltage_violation,
    CASE WHEN frequency_hz < 59.7e0 OR frequency_hz > 60.3e0 THEN 'FREQUENCY_DEVIATION' END AS frequency_violation,
    CASE WHEN power_factor < 95e-2 THEN 'POWER_FACTOR_LOW' END AS power_factor_violation
  FROM telemetry)"""
_ANY = """voltage_violation IS NOT NULL OR frequency_violation IS NOT NULL
    OR power_factor_violation IS NOT NULL"""
ORACLE["b12_wide_violations"] = _raw(f"{_WIDE} SELECT * FROM wide WHERE {_ANY}")
for _key, _like in (
    ("b13_voltage_violations", "VOLTAGE%"),
    ("b14_frequency_violations", "FREQUENCY%"),
    ("b15_pf_violations", "POWER_FACTOR%"),
):
    ORACLE[_key] = _viol(f"SELECT {_MART_COLUMNS} FROM viol WHERE violation_type LIKE '{_like}'")
ORACLE["b16_violations_mart"] = _viol(f"SELECT {_MART_COLUMNS}, action_required FROM guided")
ORACLE["b17_action_required"] = _viol(
    'SELECT system_id, "timestamp", violation_type, action_required FROM guided'
)
ORACLE["b18_analysis_stamp"] = _viol(
    """SELECT system_id, "timestamp", violation_type,
    TIMESTAMP '2024-12-16 00:00:00' AS analysis_timestamp FROM viol"""
)
ORACLE["b19_violation_log"] = _stg(
    f""", bad AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY system_id ORDER BY "timestamp") AS INT) AS position
  FROM stg WHERE {_V_BAD})
SELECT system_id, position, "timestamp", 'VOLTAGE_DEVIATION_CPUC_RULE_21' AS type,
  CASE WHEN voltage_v < 211.2e0 THEN 'CRITICAL' ELSE 'MODERATE' END AS severity,
  voltage_v AS value, 'Range A: 216.0-264.0V' AS "limit", coalesce(utility, 'Unknown') AS utility,
  CASE WHEN voltage_v < 211.2e0 THEN 'Trip inverter if Range B violated'
    ELSE 'Monitor and report to utility' END AS action
FROM bad WHERE position <= 5"""
)
ORACLE["b20_flex_window"] = _stg(
    f'SELECT system_id, "timestamp", {_FLEX} AS in_flex_window FROM stg'
)

# --- compliance --------------------------------------------------------------


def _voltage(keys: str, group: str) -> str:
    return _stg(
        f""", g AS (SELECT {keys} count(*) AS n_readings, count(*) FILTER (WHERE {_V_BAD}) AS voltage_violations,
    count(*) FILTER (WHERE voltage_v < 211.2e0) AS voltage_severe FROM stg {group})
SELECT *, round(voltage_violations * 100e0 / n_readings, 9) AS voltage_violation_rate_pct,
  round(100e0 - voltage_violations * 100e0 / n_readings, 9) AS voltage_compliance_pct FROM g"""
    )


_BY = "GROUP BY system_id"
ORACLE["c01_voltage_rate"] = _voltage("system_id,", _BY).replace(
    "SELECT *, round(voltage_violations", "SELECT * EXCLUDE (voltage_severe), round(voltage_violations"
)
ORACLE["c01_voltage_rate_fleet"] = _voltage("", "")
ORACLE["c02_voltage_severe"] = _stg(
    f"SELECT system_id, count(*) FILTER (WHERE voltage_v < 211.2e0) AS voltage_severe FROM stg {_BY}"
)
ORACLE["c03_frequency_rate"] = _stg(
    f""", g AS (SELECT system_id, count(*) AS n_readings, count(*) FILTER (WHERE {_F_BAD}) AS frequency_violations,
    count(*) FILTER (WHERE frequency_hz > 61.2e0 OR frequency_hz < 57e0) AS frequency_trips FROM stg {_BY})
SELECT *, round(frequency_violations * 100e0 / n_readings, 9) AS frequency_violation_rate_pct,
  round(100e0 - frequency_violations * 100e0 / n_readings, 9) AS frequency_compliance_pct,
  CASE WHEN frequency_trips > 0 THEN 'TRIP_REQUIRED' WHEN frequency_violations > 0 THEN 'RIDE_THROUGH'
    ELSE 'STABLE' END AS frequency_status FROM g"""
)
ORACLE["c04_pf_summary"] = _stg(
    f"""SELECT system_id, count(*) AS n_readings, count(*) FILTER (WHERE power_factor < 95e-2) AS pf_low,
  round(avg(power_factor), 9) AS pf_mean, min(power_factor) AS pf_min,
  round((1e0 - (count(*) FILTER (WHERE power_factor < 95e-2)) / CAST(count(*) AS DOUBLE)) * 100e0, 9)
    AS pf_compliance_pct FROM stg {_BY}"""
)
_WAVES = """WITH sampled AS (
  SELECT vec_id // 2 AS capture_id, CASE WHEN vec_id % 2 = 0 THEN 'voltage' ELSE 'current' END AS kind, n,
    CAST(embedding[n + 1] AS DOUBLE) AS value
  FROM embeddings CROSS JOIN (SELECT unnest(range(64)) AS n) WHERE len(embedding) > n),
parts AS (
  SELECT capture_id, kind, h, sum(value * cos(2e0 * pi() * h * n / 64e0)) AS c,
    sum(value * sin(2e0 * pi() * h * n / 64e0)) AS s, count(value) AS m
  FROM sampled CROSS JOIN (SELECT unnest(range(1, 32)) AS h) GROUP BY 1, 2, 3),
thd AS (
  SELECT capture_id, kind, CASE WHEN max(m) = 64 THEN sqrt(sum(c * c + s * s) FILTER (WHERE h = 1)) / 32e0 END AS fundamental,
    CASE WHEN max(m) = 64 THEN
      sqrt(sum(c * c + s * s) FILTER (WHERE h > 1)) / sqrt(sum(c * c + s * s) FILTER (WHERE h = 1)) * 100e0 END AS thd_pct
  FROM parts GROUP BY 1, 2)"""
ORACLE["c05_thd_check"] = f"""{_WAVES}, side AS (SELECT capture_id, max(thd_pct) FILTER (WHERE kind = 'voltage') AS v,
  max(thd_pct) FILTER (WHERE kind = 'current') AS a FROM thd GROUP BY 1)
SELECT capture_id, round(v, 6) AS thd_voltage_pct, round(a, 6) AS thd_current_pct,
  coalesce(v < 5e0 AND a < 8e0, false) AS thd_passed FROM side"""


def _flex(keys: str, group: str) -> str:
    return f""", f AS (SELECT {keys} count(*) FILTER (WHERE {_FLEX}) AS flex_readings,
    count(*) AS n_readings, sum(grid_import_kw) FILTER (WHERE NOT {_FLEX}) AS base_sum,
    sum(grid_import_kw) FILTER (WHERE {_FLEX}) AS inside_sum,
    avg(grid_import_kw) FILTER (WHERE NOT {_FLEX}) AS base,
    avg(grid_import_kw) FILTER (WHERE {_FLEX}) AS inside FROM stg {group}),
flex AS (SELECT *, CASE WHEN flex_readings > 0 THEN CASE WHEN base > 0
    THEN (base - inside) / base * 100e0 ELSE 0e0 END END AS reduction FROM f)"""


_FLEX_OUT = """n_readings, flex_readings,
  round(base_sum, 6) / nullif(n_readings - flex_readings, 0) AS baseline_import_kw,
  round(inside_sum, 6) / flex_readings AS flex_import_kw, round(reduction, 9) + 0e0 AS reduction_pct"""
_FLEX_CLASS = "CASE WHEN reduction > 10e0 THEN 'SIGNIFICANT' ELSE 'LIMITED' END AS response_class"
ORACLE["c06_flex_response"] = _stg(
    f"{_flex('system_id,', _BY)} SELECT system_id, {_FLEX_OUT} FROM flex WHERE flex_readings > 0"
)
ORACLE["c06_flex_response_fleet"] = _stg(
    f"{_flex('', '')} SELECT {_FLEX_OUT}, {_FLEX_CLASS} FROM flex WHERE flex_readings > 0"
)
ORACLE["c07_flex_class"] = _stg(
    f"{_flex('system_id,', _BY)} SELECT system_id, {_FLEX_CLASS} FROM flex WHERE flex_readings > 0"
)
ORACLE["c08_rule_status"] = _stg(
    f"""SELECT system_id, round(count(*) FILTER (WHERE {_V_BAD}) * 100e0 / count(*), 9) AS voltage_violation_rate_pct,
  CASE WHEN count(*) FILTER (WHERE {_V_BAD}) * 100e0 / count(*) < 2e0 THEN 'COMPLIANT' ELSE 'NON-COMPLIANT' END
    AS overall_status FROM stg {_BY}"""
)
ORACLE["c09_by_system"] = _viol(
    f"SELECT system_id, count(*) AS violation_count FROM viol {_BY} ORDER BY violation_count DESC, system_id"
)
ORACLE["c10_frequent_violations"] = _viol(
    """SELECT system_id, date, violation_type, count(*) AS "count" FROM viol
  WHERE date >= CAST(date_trunc('month', DATE '2024-06-15') AS DATE)
  GROUP BY system_id, date, violation_type HAVING count(*) > 1"""
)
ORACLE["c11_critical_count"] = _viol(
    "SELECT count(*) AS critical_violations FROM viol WHERE severity = 'CRITICAL'"
)
ORACLE["c12_job_violation_count"] = _raw(
    f"{_WIDE} SELECT count(*) AS violation_count FROM wide WHERE {_ANY}"
)

# --- battery -----------------------------------------------------------------


def _health(keys: str, with_keys: str = "") -> str:
    """Common table expressions up to "soh": days, cycles and health per group."""
    own = f"{keys}," if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f""", swing AS (
  SELECT {own} system_id AS unit, date, max(battery_soc_pct) AS hi, min(battery_soc_pct) AS lo,
    min("timestamp") AS t0, max("timestamp") AS t1 FROM stg GROUP BY {own} unit, date),
service AS (
  SELECT {own} CAST(floor(epoch(max(t1) - min(t0)) / 86400e0) AS INT) AS days_in_service,
    coalesce(sum((hi - lo) / 100e0), 0e0) / count(DISTINCT unit) AS equivalent_cycles FROM swing {group}),
soh AS (
  SELECT *, 100e0 - (days_in_service / 365e0 * 2e0 + equivalent_cycles / 4000e0 * 10e0) AS soh FROM service),
health AS (
  SELECT *, CASE WHEN soh >= 85e0 THEN 'HEALTHY' WHEN soh >= 70e0 THEN 'WARNING' ELSE 'CRITICAL' END AS soh_status,
    CASE WHEN soh >= 85e0 THEN 'Continue normal operation'
      WHEN soh >= 70e0 THEN 'Schedule service inspection within 6 months'
      ELSE 'Request warranty evaluation, replacement is likely' END AS soh_action,
    CASE WHEN soh > 70e0 THEN (soh - 70e0) / 2e0 ELSE 0e0 END AS eol,
    greatest(0e0, 4000e0 - equivalent_cycles) AS left_cycles FROM soh)"""


_H = _health("system_id")
ORACLE["d01_daily_swing"] = _stg(
    """SELECT system_id, date, max(battery_soc_pct) AS soc_max_pct, min(battery_soc_pct) AS soc_min_pct,
  max(battery_soc_pct) - min(battery_soc_pct) AS swing_pct FROM stg GROUP BY system_id, date"""
)
ORACLE["d02_equiv_cycles"] = _stg(
    f"{_H} SELECT system_id, round(equivalent_cycles, 9) AS equivalent_cycles FROM health"
)
ORACLE["d03_days_in_service"] = _stg(f"{_H} SELECT system_id, days_in_service FROM health")
ORACLE["d04_soh"] = _stg(
    f"""{_H} SELECT system_id, days_in_service, round(equivalent_cycles, 9) AS equivalent_cycles,
  round(soh, 9) AS soh_pct FROM health"""
)
ORACLE["d05_soh_class"] = _stg(f"{_H} SELECT system_id, soh_status, soh_action FROM health")
ORACLE["d06_eol_years"] = _stg(f"{_H} SELECT system_id, round(eol, 9) AS eol_years FROM health")
ORACLE["d07_cycles_left"] = _stg(
    f"{_H} SELECT system_id, round(left_cycles, 9) AS cycles_remaining FROM health"
)


def _steps(keys: str) -> str:
    return f""", stepped AS (
  SELECT *, lag(battery_soc_pct) OVER (PARTITION BY {keys} ORDER BY "timestamp") AS prev FROM stg),
steps AS (SELECT *, battery_soc_pct - prev AS step FROM stepped)"""


def _rte(keys: str, group: str) -> str:
    return f""", rte AS (
  SELECT {keys}, coalesce(sum(step) FILTER (WHERE step > 0), 0e0) AS up,
    coalesce(sum(-step) FILTER (WHERE step < 0), 0e0) AS down FROM steps GROUP BY {group}),
rated AS (SELECT *, CASE WHEN up <> 0 THEN down / up * 100e0 END AS eff FROM rte)"""


ORACLE["d08_soc_events"] = _stg(
    f"""{_steps('system_id')} SELECT system_id, "timestamp", battery_soc_pct, prev AS previous_battery_soc_pct,
  step AS soc_step_pct, CASE WHEN step > 0 THEN 'CHARGE' ELSE 'DISCHARGE' END AS soc_event
FROM steps WHERE step <> 0"""
)
ORACLE["d09_rte_class"] = _stg(
    f"""{_steps('system_id')}{_rte('system_id', 'system_id')}
SELECT system_id, CASE WHEN eff >= 92e0 THEN 'EXPECTED' WHEN eff >= 90e0 THEN 'LOW_END'
  WHEN eff IS NOT NULL THEN 'BELOW_SPEC' END AS rte_class FROM rated"""
)

# --- inverter ----------------------------------------------------------------

ORACLE["d10_inverter_summary"] = _stg(
    f"""SELECT system_id, count(*) AS n_readings, round(sum(inverter_efficiency_pct), 6) / count(*) AS mean_efficiency_pct,
  min(inverter_efficiency_pct) AS min_efficiency_pct, max(inverter_temp_c) AS max_temp_c,
  count(*) FILTER (WHERE inverter_efficiency_pct < 96e0) AS low_efficiency_count FROM stg {_BY}"""
)
ORACLE["d11_efficiency_band"] = _stg(
    f"""SELECT system_id, CASE WHEN avg(inverter_efficiency_pct) >= 97e0 THEN 'EXCELLENT'
  WHEN avg(inverter_efficiency_pct) >= 96e0 THEN 'ACCEPTABLE' ELSE 'DEGRADED' END AS efficiency_band
FROM stg {_BY}"""
)
ORACLE["d12_temp_eff_corr"] = _stg(
    f""", c AS (SELECT system_id, corr(inverter_temp_c, inverter_efficiency_pct) AS r, max(inverter_temp_c) AS m
  FROM stg {_BY}), d AS (SELECT system_id, CASE WHEN isnan(r) THEN NULL ELSE r END AS r, m FROM c)
SELECT system_id, round(r, 6) AS temp_eff_corr, m AS max_temp_c,
  CASE WHEN r < -4e-1 AND m > 60e0 THEN 'EXPECTED_HOT' WHEN r < -4e-1 THEN 'EXPECTED' ELSE 'WEAK' END
    AS corr_class FROM d"""
)
_THERMAL = """count(*) AS n_readings, round(sum(inverter_temp_c), 6) / count(*) AS mean_temp_c, max(inverter_temp_c) AS max_temp_c,
  round(quantile_cont(inverter_temp_c, 95e-2), 9) AS p95_temp_c FROM stg"""
ORACLE["d13_thermal_summary"] = _stg(f"SELECT system_id, {_THERMAL} {_BY}")
ORACLE["d13_thermal_monthly"] = _stg(f"SELECT system_id, month, {_THERMAL} GROUP BY system_id, month")
ORACLE["d13_thermal_summary_fleet"] = _stg(f"SELECT {_THERMAL}")
ORACLE["d14_overtemp"] = _stg(
    'SELECT system_id, "timestamp", inverter_temp_c FROM stg WHERE inverter_temp_c > 65e0'
)
ORACLE["d15_overtemp_summer"] = _stg(
    f""", g AS (SELECT system_id, count(*) FILTER (WHERE inverter_temp_c > 65e0) AS overtemp_events,
  count(*) FILTER (WHERE inverter_temp_c > 65e0 AND extract(month FROM "timestamp") IN (6, 7, 8, 9))
    AS overtemp_summer_events FROM stg {_BY})
SELECT *, CASE WHEN overtemp_summer_events > 0 THEN 'EXPECTED' WHEN overtemp_events > 0 THEN 'INVESTIGATE'
  ELSE 'WITHIN_LIMITS' END AS overtemp_class FROM g"""
)

# --- energy, report, data quality --------------------------------------------


def _energy(keys: str, source: str = "stg", extra: str = "") -> str:
    own = f"{keys}," if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f""", sums AS (SELECT {own} {extra}
    coalesce(sum(solar_production_kw), 0e0) AS solar, coalesce(sum(consumption_kw), 0e0) AS used,
    coalesce(sum(grid_export_kw), 0e0) AS exported, coalesce(sum(grid_import_kw), 0e0) AS imported
  FROM {source} {group})"""


_ENERGY_OUT = """round(solar, 6) AS solar_kwh, round(used, 6) AS consumption_kwh,
  round(exported, 6) AS grid_export_kwh, round(imported, 6) AS grid_import_kwh,
  round(exported - imported, 6) + 0e0 AS net_energy_kwh"""
_SELF_TOTAL = "CASE WHEN solar <> 0 THEN round((1e0 - exported / solar) * 100e0, 9) END AS self_consumption_pct"
_CREDIT = "round(exported * 75e-3, 8) AS export_credit_usd"
_EN = _energy("system_id")
ORACLE["e01_energy_totals"] = _stg(f"{_EN} SELECT system_id, {_ENERGY_OUT} FROM sums")
ORACLE["e02_self_consumption_total"] = _stg(f"{_EN} SELECT system_id, {_SELF_TOTAL} FROM sums")
ORACLE["e03_export_credit"] = _stg(f"{_EN} SELECT system_id, {_CREDIT} FROM sums")
ORACLE["e04_utility_mode"] = _stg(
    """SELECT utility AS utility_mode FROM stg GROUP BY utility ORDER BY count(*) DESC, utility LIMIT 1"""
)
_PERIOD = """strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') || ' to ' ||
  strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') AS reporting_period"""
ORACLE["e05_period"] = _stg(
    f"""SELECT system_id, min("timestamp") AS period_start, max("timestamp") AS period_end, {_PERIOD}
FROM stg {_BY}"""
)
_CELLS = [
    "reading_id", "system_id", '"timestamp"', "solar_production_kw", "consumption_kw", "grid_import_kw",
    "grid_export_kw", "battery_soc_pct", "battery_power_kw", "voltage_v", "frequency_hz", "inverter_temp_c",
    "inverter_efficiency_pct", "power_factor", "utility", "ingestion_timestamp",
]
_MISSING = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _CELLS)
ORACLE["e06_cell_completeness"] = _raw(
    f""", m AS (SELECT count(*) AS total_rows, {_MISSING} AS missing_cells FROM telemetry)
SELECT *, round((1e0 - missing_cells / CAST(total_rows * 16 AS DOUBLE)) * 100e0, 9) AS completeness_pct FROM m"""
)
ORACLE["e07_inverter_status"] = _stg(
    f"""SELECT system_id, CASE WHEN avg(inverter_efficiency_pct) > 96e0 THEN 'HEALTHY' ELSE 'INVESTIGATE' END
  AS inverter_status FROM stg {_BY}"""
)
ORACLE["e08_dr_status"] = _stg(
    f"""{_flex('system_id,', _BY)} SELECT system_id,
  CASE WHEN coalesce(reduction, 0e0) <> 0 THEN 'Enabled' ELSE 'N/A' END AS flex_alert_participation FROM flex"""
)


def _report(keys: str, series: str) -> str:
    """The report per group; keys is a list of columns of the staged table."""
    same = lambda t: " AND ".join(f"b.{k.strip()} = {t}.{k.strip()}" for k in keys.split(","))
    mode_keys = ", ".join(dict.fromkeys(k.strip() for k in f"{keys}, utility".split(",")))
    return _stg(
        f"""{_health(keys)}{_steps(series)}{_rte(keys, keys)}{_energy(keys)}{_flex(f'{keys},', f'GROUP BY {keys}')},
modes AS (SELECT {mode_keys}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, utility) AS place
  FROM stg GROUP BY {mode_keys}),
b AS (
  SELECT {keys}, count(*) AS n, {_PERIOD}, count(*) FILTER (WHERE {_V_BAD}) * 100e0 / count(*) AS v_rate,
    count(*) FILTER (WHERE {_F_BAD}) * 100e0 / count(*) AS f_rate, avg(power_factor) AS pf,
    avg(inverter_efficiency_pct) AS eff, count(*) FILTER (WHERE inverter_temp_c > 65e0) AS hot,
    {_MISSING} AS missing
  FROM stg GROUP BY {keys})
SELECT {', '.join(f'b.{k.strip()}' for k in keys.split(','))},
  'California NEM 3.0 Monthly Compliance & Performance' AS report_type, b.reporting_period,
  modes.utility AS utility_territory, 'CPUC Rule 21' AS interconnection_standard,
  'NEM 3.0 (effective April 2023)' AS nem_program, 85e-1 AS rated_capacity_kw, 135e-1 AS battery_capacity_kwh,
  round(100e0 - v_rate, 9) AS voltage_range_a_compliance_pct,
  round(100e0 - f_rate, 9) AS frequency_normal_range_compliance_pct,
  round(pf, 9) AS power_factor_mean, 0e0 AS thd_voltage_pct, 0e0 AS thd_current_pct,
  CASE WHEN v_rate < 2e0 THEN 'COMPLIANT' ELSE 'NON-COMPLIANT' END AS overall_status,
  'CPUC Rule 21 (2023), IEEE 1547-2018' AS standards_reference,
  round(solar, 6) AS total_solar_generation_kwh, round(used, 6) AS total_consumption_kwh,
  round(exported, 6) AS total_grid_export_kwh, round(imported, 6) AS total_grid_import_kwh,
  round(exported - imported, 6) + 0e0 AS net_energy_kwh,
  CASE WHEN solar <> 0 THEN round((1e0 - exported / solar) * 100e0, 9) END AS self_consumption_rate_pct,
  round(exported * 75e-3, 8) AS utility_credits_estimated_usd,
  CASE WHEN coalesce(reduction, 0e0) <> 0 THEN 'Enabled' ELSE 'N/A' END AS flex_alert_participation,
  round(coalesce(reduction, 0e0), 9) + 0e0 AS load_reduction_achieved_pct,
  'ELRP (Emergency Load Reduction Program)' AS program,
  round(soh, 9) AS state_of_health_pct, round(equivalent_cycles, 9) AS equivalent_cycles,
  round(left_cycles, 9) AS warranty_cycles_remaining,
  round(coalesce(rated.eff, 93e0), 9) AS round_trip_efficiency_pct, soh_status AS battery_status,
  '10 years or 4,000 cycles, 70% capacity retention' AS warranty_status, round(eol, 9) AS projected_eol_years,
  round(b.eff * n, 6) / n AS mean_efficiency_pct, hot AS thermal_events,
  CASE WHEN b.eff > 96e0 THEN 'HEALTHY' ELSE 'INVESTIGATE' END AS inverter_status,
  n AS total_data_points, missing AS missing_data_points,
  round((1e0 - missing / CAST(n * {len(_CELLS)} AS DOUBLE)) * 100e0, 9) AS data_completeness_pct
FROM b JOIN health ON {same('health')} JOIN rated ON {same('rated')} JOIN sums ON {same('sums')}
  JOIN flex ON {same('flex')} JOIN modes ON {same('modes')} AND modes.place = 1"""
    )


ORACLE["e09_monthly_report"] = _report("system_id, month", "system_id, month")
ORACLE["a09_report_roundtrip"] = ORACLE["e09_monthly_report"]
ORACLE["d16_outlier_counts"] = _stg(
    """SELECT utility, count(*) AS n_rows, count(*) FILTER (WHERE reading_id % 199 = 0) AS n_planted,
  count(*) FILTER (WHERE reading_id % 199 = 0) AS n_found, true AS share_held
FROM stg WHERE reading_id % 199 = 0 OR (inverter_temp_c IS NOT NULL AND inverter_efficiency_pct IS NOT NULL)
GROUP BY utility"""
)
ORACLE["run_days"] = _report("system_id", "system_id")
ORACLE["e09_utility_report"] = _report("utility, month", "utility, month, system_id")
ORACLE["e10_system_completeness"] = _raw(
    """, s AS (SELECT count(DISTINCT system_id) AS actual_systems FROM telemetry)
SELECT actual_systems, round(actual_systems * 100e0 / 150e0, 9) AS completeness_pct,
  actual_systems * 100e0 / 150e0 >= 95e0 AS passed FROM s"""
)
_UNPHYSICAL = "count(*) FILTER (WHERE voltage_v < 200e0 OR voltage_v > 280e0) AS invalid_voltage_records"
ORACLE["e11_invalid_voltage"] = _raw(f"SELECT {_UNPHYSICAL} FROM telemetry")
_AGE = "epoch(TIMESTAMP '2024-12-16 00:00:00' - latest_timestamp) / 3600e0"
ORACLE["e12_freshness"] = _stg(
    f""", f AS (SELECT max("timestamp") AS latest_timestamp FROM stg)
SELECT latest_timestamp, round({_AGE}, 9) AS data_age_hours, {_AGE} <= 24e0 AS passed FROM f"""
)
ORACLE["e13_quality_gate"] = _raw(
    f""", g AS (SELECT count(DISTINCT system_id) AS actual_systems, {_UNPHYSICAL},
  max("timestamp") AS latest_timestamp FROM telemetry)
SELECT *, round(actual_systems * 100e0 / 150e0, 9) AS completeness_pct, round({_AGE}, 9) AS data_age_hours,
  actual_systems * 100e0 / 150e0 >= 95e0 AS completeness_passed, {_AGE} <= 24e0 AS freshness_passed,
  invalid_voltage_records = 0 AS voltage_passed,
  actual_systems * 100e0 / 150e0 >= 95e0 AND {_AGE} <= 24e0 AS gate_passed FROM g"""
)

# --- time series, demand response, marts, stream -----------------------------

_SPINE = """, spine AS (
  SELECT system_id, slot FROM (SELECT DISTINCT system_id FROM stg)
  CROSS JOIN (SELECT unnest(generate_series((SELECT min("timestamp") FROM stg), (SELECT max("timestamp") FROM stg),
    INTERVAL 1 HOUR)) AS slot))"""
ORACLE["x01_missing_readings"] = _stg(
    f"""{_SPINE} SELECT system_id, slot AS "timestamp" FROM spine ANTI JOIN stg
  ON spine.system_id = stg.system_id AND spine.slot = stg."timestamp\""""
)
ORACLE["x01_missing_counts"] = _stg(
    f"""{_SPINE} SELECT spine.system_id, count(*) AS expected_readings, count(stg.system_id) AS present_readings,
  count(*) - count(stg.system_id) AS missing_readings
FROM spine LEFT JOIN stg ON spine.system_id = stg.system_id AND spine.slot = stg."timestamp" GROUP BY 1"""
)
ORACLE["x02_net_flow"] = _raw(
    """SELECT reading_id, greatest(0e0, consumption_kw - solar_production_kw) AS grid_import_kw,
  greatest(0e0, solar_production_kw - consumption_kw) AS grid_export_kw FROM telemetry"""
)
ORACLE["x03_round_trip_eff"] = _stg(
    f"""{_steps('system_id')}{_rte('system_id', 'system_id')}
SELECT system_id, round(up, 9) AS charged_pct, round(down, 9) AS discharged_pct,
  round(eff, 9) AS round_trip_efficiency_pct FROM rated"""
)
ORACLE["x04_thd"] = (
    f"{_WAVES} SELECT capture_id, kind, round(fundamental, 6) AS fundamental, round(thd_pct, 6) AS thd_pct FROM thd"
)
ORACLE["x05_gaps"] = _stg(
    """, g AS (SELECT system_id, "timestamp",
  lag("timestamp") OVER (PARTITION BY system_id ORDER BY "timestamp") AS previous_timestamp FROM stg)
SELECT *, round(epoch("timestamp" - previous_timestamp) / 3600e0, 9) AS gap_hours FROM g
WHERE epoch("timestamp" - previous_timestamp) / 3600e0 > 2e0"""
)
ORACLE["x06_daily_completeness"] = _stg(
    """SELECT system_id, date, count(*) AS n_readings, round(count(*) * 100e0 / 24e0, 9) AS completeness_pct,
  count(*) * 100e0 / 24e0 >= 95e0 AS passed FROM stg GROUP BY system_id, date"""
)
_BASELINE = """, hourly AS (SELECT system_id, date, hour_of_day, sum(grid_import_kw) AS s, count(grid_import_kw) AS c,
    count(*) AS n_readings FROM stg GROUP BY system_id, date, hour_of_day),
based AS (SELECT *, sum(s) OVER w / nullif(sum(c) OVER w, 0) AS base, s / c AS actual FROM hourly
  WINDOW w AS (PARTITION BY system_id, hour_of_day ORDER BY date - DATE '1970-01-01'
    RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING))"""
ORACLE["x07_dr_baseline"] = _stg(
    f"""{_BASELINE} SELECT system_id, date, hour_of_day, n_readings, round(base, 9) AS baseline_kw,
  round(actual, 9) AS actual_kw, round(base - actual, 9) + 0e0 AS reduction_kw FROM based"""
)
ORACLE["x08_dr_settlement"] = _stg(
    f"""{_BASELINE}, p AS (SELECT stg.system_id, stg.date,
  coalesce(sum(CASE WHEN base - grid_import_kw IS NOT NULL THEN greatest(0e0, base - grid_import_kw) END), 0e0) AS kwh
  FROM stg JOIN based ON stg.system_id = based.system_id AND stg.date = based.date AND stg.hour_of_day = based.hour_of_day
  WHERE stg.hour_of_day BETWEEN 16 AND 21 AND extract(month FROM stg.date) BETWEEN 6 AND 9
  GROUP BY stg.system_id, stg.date)
SELECT system_id, date, round(kwh, 9) AS reduced_kwh, round(kwh * 2e0, 9) AS settlement_usd FROM p"""
)
ORACLE["x09_sustained_episodes"] = _stg(
    """, m AS (SELECT system_id, "timestamp", NOT (voltage_v BETWEEN 216e0 AND 264e0) AS bad,
    row_number() OVER (PARTITION BY system_id ORDER BY "timestamp") AS r FROM stg WHERE voltage_v IS NOT NULL),
i AS (SELECT *, r - row_number() OVER (PARTITION BY system_id ORDER BY "timestamp") AS island FROM m WHERE bad),
e AS (SELECT system_id, min("timestamp") AS run_start, max("timestamp") AS run_end, count(*) AS n_readings
  FROM i GROUP BY system_id, island)
SELECT system_id, run_start, run_end, n_readings, round(epoch(run_end - run_start) / 60e0, 9) AS minutes
FROM e WHERE epoch(run_end - run_start) / 60e0 > 5e0"""
)
ORACLE["x09_stream_episodes"] = f"SELECT * EXCLUDE (minutes) FROM ({ORACLE['x09_sustained_episodes']})"
ORACLE["x10_disconnect"] = _stg(
    """SELECT system_id, "timestamp", frequency_hz, round(abs(frequency_hz - 60e0), 9) AS frequency_off_hz
FROM stg WHERE abs(frequency_hz - 60e0) > 5e-1"""
)
_HEALTH_OUT = """days_in_service, round(equivalent_cycles, 9) AS equivalent_cycles, round(soh, 9) AS soh_pct,
  soh_status, soh_action, round(eol, 9) AS eol_years, round(left_cycles, 9) AS cycles_remaining"""
ORACLE["x11_battery_mart"] = _stg(
    f"{_health('system_id, month')} SELECT system_id, month, {_HEALTH_OUT} FROM health"
)
_COUNT = "count(*) AS n_readings,"
ORACLE["x12_energy_mart"] = _stg(
    f"""{_energy('utility, system_id, date', extra=_COUNT)}
SELECT utility, system_id, date, n_readings, {_ENERGY_OUT}, {_SELF_TOTAL}, {_CREDIT} FROM sums"""
)
ORACLE["x12_energy_rollup"] = _stg(
    f""", sums AS (SELECT utility, month, CAST(grouping(utility, month) AS INT) AS level, count(*) AS n_readings,
    sum(solar_production_kw) AS solar, sum(consumption_kw) AS used, sum(grid_export_kw) AS exported,
    sum(grid_import_kw) AS imported FROM stg GROUP BY ROLLUP (utility, month))
SELECT utility, month, level, n_readings, {_ENERGY_OUT}, {_SELF_TOTAL}, {_CREDIT} FROM sums"""
)
ORACLE["x13_merge_sources"] = _stg(
    """SELECT system_id, "timestamp", solar_production_kw, consumption_kw, grid_import_kw, grid_export_kw,
  battery_soc_pct, battery_power_kw, coalesce(voltage_v, 240e0) AS voltage_v,
  coalesce(frequency_hz, 60e0) AS frequency_hz, power_factor, inverter_temp_c, inverter_efficiency_pct,
  CAST(3 AS BIGINT) AS n_sources, 'app' AS best_source FROM stg"""
)

ORACLE["x13_merge_shifted"] = _stg(
    """, meter AS (SELECT system_id, "timestamp" - INTERVAL 7 MINUTE AS at, voltage_v, frequency_hz, power_factor FROM stg),
logger AS (SELECT system_id, "timestamp" - INTERVAL 40 MINUTE AS at, 240e0 AS voltage_v, inverter_temp_c,
    inverter_efficiency_pct FROM stg WHERE extract(hour FROM "timestamp") % 3 = 0),
j AS (SELECT a.system_id, a."timestamp", a.solar_production_kw, a.consumption_kw, m AS m, l AS l,
    epoch(a."timestamp" - m.at) / 60e0 AS m_age, epoch(a."timestamp" - l.at) / 60e0 AS l_age
  FROM stg a ASOF LEFT JOIN meter m ON a.system_id = m.system_id AND a."timestamp" >= m.at
    ASOF LEFT JOIN logger l ON a.system_id = l.system_id AND a."timestamp" >= l.at)
SELECT system_id, "timestamp", solar_production_kw, consumption_kw,
  coalesce(CASE WHEN m_age <= 180 THEN m.voltage_v END, CASE WHEN l_age <= 180 THEN l.voltage_v END) AS voltage_v,
  CASE WHEN m_age <= 180 THEN m.frequency_hz END AS frequency_hz, CASE WHEN m_age <= 180 THEN m.power_factor END AS power_factor,
  CASE WHEN l_age <= 180 THEN l.inverter_temp_c END AS inverter_temp_c,
  CASE WHEN l_age <= 180 THEN l.inverter_efficiency_pct END AS inverter_efficiency_pct,
  CAST(1 + coalesce(m_age <= 180, false)::INT + coalesce(l_age <= 180, false)::INT AS INT) AS n_sources,
  CASE WHEN m_age <= 180 THEN round(m_age, 9) END AS meter_age_minutes,
  CASE WHEN l_age <= 180 THEN round(l_age, 9) END AS logger_age_minutes
FROM j"""
)

_ARRIVALS = """, arrived AS (
  SELECT id, ts, solar_at, voltage_v, frequency_hz, power_factor FROM (
    SELECT m.id, m.ts, CASE WHEN m.id % 97 = 0 THEN -5e-1
        WHEN extract(hour FROM m.ts) BETWEEN 6 AND 18 THEN least(m.value, 100e0) / 100e0 * 85e-1
        ELSE 0e0 END AS solar_at, t.voltage_v, t.frequency_hz, t.power_factor,
      row_number() OVER (PARTITION BY t.system_id, m.ts ORDER BY m.id) AS copy
    FROM mapped m JOIN telemetry t ON m.id = t.reading_id WHERE t.system_id IS NOT NULL) WHERE copy = 1),
found AS (
  SELECT ts, CASE WHEN voltage_v < 220.8e0 THEN 'VOLTAGE_LOW' ELSE 'VOLTAGE_HIGH' END AS violation_type,
    CASE WHEN abs(voltage_v - 240e0) / 240e0 > 10e-2 THEN 'SEVERE' ELSE 'MODERATE' END AS severity
  FROM arrived WHERE voltage_v < 220.8e0 OR voltage_v > 259.20000000000005e0
  UNION ALL
  SELECT ts, CASE WHEN frequency_hz < 59.7e0 THEN 'FREQUENCY_LOW' ELSE 'FREQUENCY_HIGH' END, 'CRITICAL'
  FROM arrived WHERE frequency_hz < 59.7e0 OR frequency_hz > 60.3e0
  UNION ALL
  SELECT ts, 'POWER_FACTOR_LOW', 'MODERATE' FROM arrived WHERE power_factor < 95e-2 AND solar_at > 1e0),
counted AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, violation_type, severity,
    count(*) AS violation_count FROM found GROUP BY 1, 2, 3)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, violation_type, severity, violation_count
FROM counted"""
ORACLE["x14_batch_counts"] = _raw(_ARRIVALS)
ORACLE["x14_stream_counts"] = ORACLE["x14_batch_counts"]

_EXPECT = {
    "not_null_system_id": "system_id IS NULL",
    "not_null_timestamp": '"timestamp" IS NULL',
    "not_null_voltage_v": "voltage_v IS NULL",
    "accepted_values_utility": "utility NOT IN ('PGE', 'SCE')",
    "range_voltage_v": "voltage_v NOT BETWEEN 200e0 AND 280e0",
    "range_battery_soc_pct": "battery_soc_pct NOT BETWEEN 0e0 AND 100e0",
}
ORACLE["x15_expectations"] = _raw(
    ", r AS ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS expectation, count(*) AS failed_rows FROM telemetry WHERE {c}"
        for n, c in _EXPECT.items()
    )
    + """ UNION ALL SELECT 'unique_system_id_timestamp', CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM telemetry WHERE system_id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY system_id, "timestamp"))
SELECT *, failed_rows = 0 AS passed FROM r"""
)

ORACLE["x15_rows_set_aside"] = _raw(
    """, first AS (SELECT system_id, "timestamp", min(reading_id) AS least FROM telemetry
  WHERE system_id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY system_id, "timestamp"),
tagged AS (SELECT t.reading_id, t.system_id, t."timestamp", concat_ws(',', """
    + ", ".join(f"CASE WHEN t.{c} THEN '{n}' END" for n, c in _EXPECT.items())
    + """, CASE WHEN t.reading_id <> f.least THEN 'unique_system_id_timestamp' END) AS failed_checks
  FROM telemetry t LEFT JOIN first f ON t.system_id = f.system_id AND t."timestamp" = f."timestamp")
SELECT * FROM tagged WHERE failed_checks <> ''"""
)


def _tou(keys: str) -> str:
    return _stg(
        f"""{_steps('system_id')} SELECT {keys} CASE WHEN hour_of_day <= 14 THEN 'OFF_PEAK'
    WHEN hour_of_day BETWEEN 16 AND 20 THEN 'PEAK' ELSE 'OTHER' END AS period,
  round(coalesce(sum(step / 100e0 * 135e-1) FILTER (WHERE step > 0), 0e0), 6) AS charge_kwh,
  round(coalesce(sum(-step / 100e0 * 135e-1) FILTER (WHERE step < 0), 0e0), 6) AS discharge_kwh
FROM steps GROUP BY {keys} period"""
    )


ORACLE["x16_tou_split"] = _tou("")
ORACLE["x16_tou_split_by_system"] = _tou("system_id,")
ORACLE["x17_fade_rate"] = _stg(
    f"""{_H}, f AS (SELECT system_id, days_in_service, soh,
  (100e0 - soh) * 365e0 / nullif(days_in_service, 0) AS fade FROM health)
SELECT system_id, days_in_service, round(soh, 9) AS soh_pct, round(fade, 9) AS fade_pct_per_year,
  fade > 25e-1 AS exceeds_limit FROM f"""
)
ORACLE["x18_compliance_extract"] = _viol(
    f""", rates AS (SELECT utility, date, count(*) AS n_readings,
  round(100e0 - count(*) FILTER (WHERE {_V_BAD}) * 100e0 / count(*), 9) AS voltage_compliance_pct,
  round(100e0 - count(*) FILTER (WHERE {_F_BAD}) * 100e0 / count(*), 9) AS frequency_compliance_pct,
  round((1e0 - (count(*) FILTER (WHERE power_factor < 95e-2)) / CAST(count(*) AS DOUBLE)) * 100e0, 9)
    AS pf_compliance_pct FROM stg GROUP BY utility, date),
counts AS (SELECT utility, date, violation_type, count(*) AS c FROM viol GROUP BY 1, 2, 3),
kinds AS (SELECT unnest(['VOLTAGE_LOW', 'VOLTAGE_HIGH', 'FREQUENCY_LOW', 'FREQUENCY_HIGH', 'POWER_FACTOR_LOW'])
  AS violation_type)
SELECT r.*, k.violation_type, coalesce(c.c, 0) AS violation_count
FROM rates r CROSS JOIN kinds k LEFT JOIN counts c
  ON r.utility = c.utility AND r.date = c.date AND k.violation_type = c.violation_type"""
)
ORACLE["x19_soh_fleet"] = _stg(
    f"""{_health('utility, system_id')} SELECT utility, count(*) AS n_systems,
  count(*) FILTER (WHERE soh_status = 'HEALTHY') AS healthy, count(*) FILTER (WHERE soh_status = 'WARNING') AS warning,
  count(*) FILTER (WHERE soh_status = 'CRITICAL') AS critical,
  round(min(soh), 9) AS min_soh_pct, round(avg(soh), 9) AS mean_soh_pct FROM health GROUP BY utility"""
)
ORACLE["x19_worst_batteries"] = _stg(
    f"""{_H} SELECT system_id, round(soh, 9) AS soh_pct, soh_status,
  round(equivalent_cycles, 9) AS equivalent_cycles, days_in_service
FROM health ORDER BY soh, system_id LIMIT 10"""
)
