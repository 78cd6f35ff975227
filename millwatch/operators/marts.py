"""One health row per machine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.functions.readings import risk_tier


def machine_totals(staging: DataFrame) -> DataFrame:
    """Mergeable totals per machine: totals of parts add up to the totals of the whole.

    Counts, sums and extremes combine before the shuffle, so a machine with a third of all readings
    sends no more rows than any other.
    """
    return staging.groupBy("machine_id").agg(
        F.max("event_time").alias("last_reading_time"),
        F.count("*").alias("total_readings"),
        F.count_if(F.col("reading_status") == "anomalous").alias("anomalous_readings"),
        F.sum("avg_temperature").alias("temperature_sum"),
        F.count("avg_temperature").alias("temperature_count"),
        F.max("max_vibration").alias("max_vibration"),
        F.min("signal_strength").alias("min_signal_strength"),
    )


def merge_totals(*parts: DataFrame) -> DataFrame:
    """Totals over all parts."""
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("machine_id")
        .agg(
            F.max("last_reading_time").alias("last_reading_time"),
            F.sum("total_readings").alias("total_readings"),
            F.sum("anomalous_readings").alias("anomalous_readings"),
            F.sum("temperature_sum").alias("temperature_sum"),
            F.sum("temperature_count").alias("temperature_count"),
            F.max("max_vibration").alias("max_vibration"),
            F.min("min_signal_strength").alias("min_signal_strength"),
        )
    )


def assess(totals: DataFrame) -> DataFrame:
    """Mart rows from totals."""
    mean = F.try_divide(F.col("temperature_sum"), F.col("temperature_count"))
    return (
        totals.withColumn("avg_temperature", mean)
        .withColumn("tier", risk_tier(F.col("avg_temperature"), F.col("max_vibration")))
        .select(
            "machine_id",
            "last_reading_time",
            "total_readings",
            "anomalous_readings",
            "avg_temperature",
            "max_vibration",
            "min_signal_strength",
            "tier.*",
        )
    )


def machine_health(staging: DataFrame) -> DataFrame:
    """The mart: one row per machine with at least one valid reading."""
    return assess(machine_totals(staging))
