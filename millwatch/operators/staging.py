"""Validated, scored and flagged readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch import settings as S
from millwatch.functions import readings as R


def staging_readings(
    history: DataFrame,
    threshold: float = S.ANOMALY_ABOVE["temperature"],
    include_invalid: bool = False,
) -> DataFrame:
    """Staging rows. Readings with an impossible or missing value are left out unless asked for.

    With `include_invalid` such values show as NULL. Without, the ranges are plain comparisons on stored
    columns, which the file scan uses to skip row groups, and nothing is left to set to NULL.
    """
    if include_invalid:
        sensors = {c: R.clamp_to_null(F.col(c), *S.VALID_RANGE[c]) for c in S.SENSORS}
    else:
        history = valid_only(history)
        sensors = {c: F.col(c) for c in S.SENSORS}
    rows = history.select(
        "machine_id",
        "event_time",
        sensors["temperature"].alias("avg_temperature"),
        sensors["vibration"].alias("max_vibration"),
        sensors["pressure"].alias("pressure"),
        R.signal_strength(F.col("status_code")).alias("signal_strength"),
        "status_code",
    )
    clean = [F.col("avg_temperature"), F.col("max_vibration"), F.col("pressure")]
    flag = R.is_anomalous(*clean, F.col("status_code"), threshold=threshold)
    rows = rows.withColumn("is_anomalous", flag).drop("status_code")
    return rows.withColumn("reading_status", R.reading_status(clean, F.col("is_anomalous")))


def valid_only(readings: DataFrame) -> DataFrame:
    """Readings whose three values all lie in their ranges; NULL and NaN do not."""
    for sensor, (low, high) in S.VALID_RANGE.items():
        readings = readings.filter(F.col(sensor).between(low, high))
    return readings


def classification_drift(readings: DataFrame) -> DataFrame:
    """How often each reported code meets each code the values deserve."""
    derived = R.classify_reading(*[F.col(c) for c in S.SENSORS])
    return (
        readings.select(F.col("status_code").alias("reported"), derived.alias("derived"))
        .groupBy("reported", "derived")
        .agg(F.count("*").alias("readings"))
    )
