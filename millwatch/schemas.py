"""Canonical schemas of the landing, history, staging and mart tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


LANDING = _schema(
    machine_id="string",
    timestamp="timestamp_ntz",
    temperature="double",
    vibration="double",
    pressure="double",
    status_code="string",
)
HISTORY = _schema(
    machine_id="string",
    event_time="timestamp_ntz",
    temperature="double",
    vibration="double",
    pressure="double",
    status_code="string",
    _loaded_at="timestamp",
)
STAGING = _schema(
    machine_id="string",
    event_time="timestamp_ntz",
    avg_temperature="double",
    max_vibration="double",
    pressure="double",
    signal_strength="integer",
    is_anomalous="boolean",
    reading_status="string",
)
MART = _schema(
    machine_id="string",
    last_reading_time="timestamp_ntz",
    total_readings="long",
    anomalous_readings="long",
    avg_temperature="double",
    max_vibration="double",
    min_signal_strength="integer",
    failure_risk_score="integer",
    health_status="string",
    maintenance_recommendation="string",
)
