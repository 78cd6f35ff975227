"""Column rules for single readings and single machines. All of them stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millwatch import settings as S


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def clamp_to_null(value: Column, low: float, high: float) -> Column:
    """The value inside the closed range, NULL outside. NaN sorts above every number: NULL."""
    return F.when(value.between(low, high), value)


def signal_strength(status_code: Column) -> Column:
    """Strength by exact code; unknown codes and NULL count as no signal."""
    known = F.lit(None).cast("int")
    for code, strength in S.SIGNAL_STRENGTH.items():
        known = F.when(status_code == code, F.lit(strength)).otherwise(known)
    return F.coalesce(known, F.lit(S.SIGNAL_STRENGTH_OTHERWISE))


def is_anomalous(
    temperature: Column,
    vibration: Column,
    pressure: Column,
    status_code: Column,
    threshold: float = S.ANOMALY_ABOVE["temperature"],
) -> Column:
    """TRUE when any rule fires; an undecided rule set (NULLs) is FALSE, never NULL."""
    rules = [
        temperature > threshold,
        vibration > S.ANOMALY_ABOVE["vibration"],
        pressure > S.ANOMALY_ABOVE["pressure"],
        status_code == S.ANOMALY_STATUS,
    ]
    return F.coalesce(any_of(rules), F.lit(False))


def reading_status(validated: list[Column], anomalous: Column) -> Column:
    missing = any_of([c.isNull() for c in validated])
    return F.when(missing, "invalid").otherwise(F.when(anomalous, "anomalous").otherwise("normal"))


def risk_tier(avg_temperature: Column, max_vibration: Column) -> Column:
    """Struct of score, status and recommendation. No finding (NULL included) is the lowest tier."""
    *findings, lowest = S.TIERS

    def as_struct(tier: S.Tier) -> Column:
        return F.struct(
            F.lit(tier.failure_risk_score).alias("failure_risk_score"),
            F.lit(tier.health_status).alias("health_status"),
            F.lit(tier.maintenance_recommendation).alias("maintenance_recommendation"),
        )

    outcome = as_struct(lowest)
    for tier in reversed(findings):
        hit = (avg_temperature > tier.avg_temperature_above) | (max_vibration > tier.max_vibration_above)
        outcome = F.when(hit, as_struct(tier)).otherwise(outcome)
    return outcome


def classify_reading(temperature: Column, vibration: Column, pressure: Column) -> Column:
    """The status code a reading deserves by its own values."""
    code = F.lit(S.LABEL_OTHERWISE)
    for label, hot, shaky, high, low in reversed(S.LABEL_RULES):
        hit = (temperature >= hot) | (vibration >= shaky) | (pressure >= high) | (pressure <= low)
        code = F.when(hit, label).otherwise(code)
    return code


def gauge_band(value: Column, sensor: str) -> Column:
    """Band 1 to 3 on the sensor's gauge, lower edge inclusive, the last band closed; NULL off the scale."""
    start, first, second, end = S.GAUGE_EDGES[sensor]
    band = F.lit(1) + (value >= first).cast("int") + (value >= second).cast("int")
    return F.when(value.between(start, end), band)


def over_alarm_line(value: Column, sensor: str) -> Column:
    return value > S.GAUGE_EDGES[sensor][2]


def risk_label(health_status: Column) -> Column:
    label = F.lit(S.RISK_LABEL_OTHERWISE)
    for status, text in S.RISK_LABELS.items():
        label = F.when(health_status == status, text).otherwise(label)
    return label


def status_rank(health_status: Column) -> Column:
    """0, 1, 2 from best to worst, NULL for an unknown status."""
    position = F.array_position(F.array(*[F.lit(s) for s in S.HEALTH_STATUSES]), health_status)
    return F.when(position > 0, (position - 1).cast("int"))


def is_urgent(recommendation: Column) -> Column:
    text = F.lower(recommendation)
    return text.contains("urgent") | text.contains("immediate")
