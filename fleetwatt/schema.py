"""Telemetry schema. Timestamps are wall-clock time without a zone."""

from __future__ import annotations

from pyspark.sql import types as T

# Measurement column names.
MEASURES = [
    "solar_production_kw",
    "consumption_kw",
    "grid_import_kw",
    "grid_export_kw",
    "battery_soc_pct",
    "battery_power_kw",
    "voltage_v",
    "frequency_hz",
    "inverter_temp_c",
    "inverter_efficiency_pct",
    "power_factor",
]
KEYS = ["system_id", "timestamp"]

TELEMETRY_SCHEMA = T.StructType(
    [
        T.StructField("system_id", T.StringType(), False),
        T.StructField("timestamp", T.TimestampNTZType(), False),
    ]
    + [T.StructField(name, T.DoubleType(), True) for name in MEASURES]
)

# The raw table also carries the reading number (tie-break), the utility and
# the time of ingestion. Its keys are nullable: staging drops null keys.
RAW_SCHEMA = T.StructType(
    [T.StructField("reading_id", T.LongType(), True)]
    + [T.StructField(f.name, f.dataType, True) for f in TELEMETRY_SCHEMA]
    + [
        T.StructField("utility", T.StringType(), True),
        T.StructField("ingestion_timestamp", T.TimestampNTZType(), True),
    ]
)
RAW_COLUMNS = KEYS + MEASURES + ["ingestion_timestamp"]
