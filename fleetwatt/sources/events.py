"""Telemetry derived from an event table by a deterministic mapping.

The mapping uses integer arithmetic and double products only, so that another
engine can derive the same rows bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A timestamp without a zone, cut to the hour (date_trunc would add a zone), and
# moved by up to eleven months per user; or the event's own time, for a stream.
_EVENT_TIME = {
    "spread": """CAST(to_date(ts) AS TIMESTAMP_NTZ)
        + make_dt_interval(CAST((user_id % 12) * 30 - 10 AS INT), hour(ts))""",
    "arrival": "ts",
}

# Each stage may use the columns of the one before.
_INPUTS = [
    "event_id AS id",
    "ts",
    "user_id",
    "value",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    "CAST((event_id * 7919) % 601 - 300 AS DOUBLE) / 300D AS u",
    "CAST((event_id * 104729) % 601 - 300 AS DOUBLE) / 300D AS w",
]
_POWER = [
    "*",
    """CASE WHEN id % 97 = 0 THEN -0.5D
        WHEN hour(`timestamp`) BETWEEN 6 AND 18 THEN least(value, 100D) / 100D * 8.5D
        ELSE 0D END AS solar""",
    "0.5D + k / 40D AS used",
]
_HEAT = [
    "*",
    """30D + solar * 2.5D + CAST(id % 50 AS DOUBLE) / 5D
        + CASE WHEN id % 67 = 0 THEN 30D ELSE 0D END AS heat""",
]
_READING = [
    "id AS reading_id",
    "CASE WHEN id % 211 <> 0 THEN concat('SYS-', lpad(CAST(user_id AS STRING), 5, '0')) END AS system_id",
    "`timestamp`",
    "solar AS solar_production_kw",
    "used AS consumption_kw",
    "greatest(0D, used - solar) AS grid_import_kw",
    "greatest(0D, solar - used) AS grid_export_kw",
    "15D + CAST((id * 37) % 81 AS DOUBLE) AS battery_soc_pct",
    "CAST((id * 53) % 501 - 250 AS DOUBLE) / 100D AS battery_power_kw",
    """CASE WHEN id % 101 = 0 THEN NULL WHEN id % 997 = 0 THEN 195D
        ELSE 240D + 32D * u * u * u END AS voltage_v""",
    """CASE WHEN id % 103 = 0 THEN NULL WHEN id % 499 = 0 THEN 56.5D WHEN id % 503 = 0 THEN 61.5D
        ELSE 60D + 0.8D * w * w * w END AS frequency_hz""",
    "heat AS inverter_temp_c",
    """97.8D - (heat - 35D) * 0.04D + CAST((id * 31) % 13 - 6 AS DOUBLE) / 10D
        - CASE WHEN id % 41 = 0 THEN 3D ELSE 0D END AS inverter_efficiency_pct""",
    "0.945D + CAST((id * 11) % 56 AS DOUBLE) / 1000D AS power_factor",
    "CASE user_id % 3 WHEN 0 THEN 'PGE' WHEN 1 THEN 'SCE' ELSE 'SDGE' END AS utility",
    "ts AS ingestion_timestamp",
]


def map_events(events: DataFrame, event_time: str = "spread") -> DataFrame:
    """Telemetry rows from events, at the spread or the arrival time."""
    read_at = f"{_EVENT_TIME[event_time]} AS `timestamp`"
    return (
        events.selectExpr(*_INPUTS, read_at)
        .selectExpr(*_POWER)
        .selectExpr(*_HEAT)
        .selectExpr(*_READING)
    )


def telemetry_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
