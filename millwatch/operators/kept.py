"""Figures kept by adding: rows of parts merge to those of the whole, so a load costs what the load holds.

Sums and counts of the sensors per machine give averages, and with the mart the correlations. Sketches of
machines per day give distinct counts of any range of days without the readings. Counts combine before the shuffle,
so neither a machine nor a day with most of the readings is one task's work.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch import settings as S

SKETCH_LOG2 = 14  # registers of a sketch, as a power of two; a sketch has 16 KB at most
SKETCH_ERROR = 3 * 1.04 / math.sqrt(2**SKETCH_LOG2)  # three standard errors, as a share of the count
AVERAGES = {"temperature": "avg_temp", "vibration": "avg_vibration", "pressure": "avg_pressure"}


def sensor_totals(readings: DataFrame) -> DataFrame:
    """Per machine the number and sum of each sensor's values. Missing values count on neither; a NULL machine has a row."""
    return readings.groupBy("machine_id").agg(
        *(F.count(c).alias(f"{c}_count") for c in S.SENSORS), *(F.sum(c).alias(f"{c}_sum") for c in S.SENSORS)
    )


def merge_sensor_totals(*parts: DataFrame) -> DataFrame:
    """Totals over all parts."""
    names = [f"{c}_{kind}" for kind in ("count", "sum") for c in S.SENSORS]
    return reduce(DataFrame.unionByName, parts).groupBy("machine_id").agg(*(F.sum(n).alias(n) for n in names))


def averages(totals: DataFrame) -> DataFrame:
    """Sensor averages per machine from merged totals; NULL for a sensor without values."""
    return totals.select("machine_id", *(F.try_divide(f"{c}_sum", f"{c}_count").alias(name) for c, name in AVERAGES.items()))


def machine_days(readings: DataFrame) -> DataFrame:
    """Per day the number of readings and a sketch of their machines. Readings without a time have the NULL day; a NULL machine is not counted."""
    return readings.groupBy(F.to_date("event_time").alias("day")).agg(
        F.count("*").alias("n_readings"), F.hll_sketch_agg("machine_id", F.lit(SKETCH_LOG2)).alias("machines")
    )


def merge_machine_days(*parts: DataFrame) -> DataFrame:
    """One row per day over all parts."""
    return reduce(DataFrame.unionByName, parts).groupBy("day").agg(
        F.sum("n_readings").alias("n_readings"), F.hll_union_agg("machines").alias("machines")
    )


def key_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the number of rows. NULL is a value like others here."""
    return rows.groupBy(*keys).agg(F.count("*").alias("occurrences"))


def merge_key_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key over all parts."""
    return counts.groupBy(*keys).agg(F.sum("occurrences").alias("occurrences"))


def day_uniqueness(counts: DataFrame, day: str) -> DataFrame:
    """Per day, from merged key counts: rows, keys, keys with several rows, and rows beyond the first of their key."""
    n = F.col("occurrences")
    return counts.groupBy(day).agg(
        F.sum(n).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if(n > 1).alias("repeated_keys"),
        (F.sum(n) - F.count("*")).alias("surplus_rows"),
    )


def machines_of(days: DataFrame) -> DataFrame:
    """One row: readings and machines of some days, machines to within SKETCH_ERROR in all but three of a thousand cases. Zeros for no day."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("machines"))
    return days.agg(F.coalesce(F.sum("n_readings"), F.lit(0)).alias("n_readings"), F.coalesce(estimate, F.lit(0)).alias("n_machines"))


def within_error(estimate: Column, exact: Column) -> Column:
    """Whether an estimate is as near as a sketch promises; one more for rounding."""
    return F.abs(estimate - exact) <= F.lit(SKETCH_ERROR) * exact + 1
