"""Factory-level figures over the mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.functions import readings as R


def factory_overview(mart: DataFrame) -> DataFrame:
    """One row: machines, healthy and critical numbers with percentages, mean risk."""
    machines = F.count_distinct(F.coalesce("machine_id", F.lit("None")))
    healthy = F.count_if(F.col("health_status") == "HEALTHY")
    critical = F.count_if(F.col("health_status") == "CRITICAL")
    return mart.agg(
        machines.alias("total_machines"),
        healthy.alias("healthy_machines"),
        (F.try_divide(healthy, machines) * 100).alias("healthy_percent"),
        critical.alias("critical_machines"),
        (F.try_divide(critical, machines) * 100).alias("critical_percent"),
        F.avg("failure_risk_score").alias("avg_risk_score"),
    )


def risk_stats(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.avg("failure_risk_score").alias("mean_risk"),
        F.min("failure_risk_score").alias("min_risk"),
        F.max("failure_risk_score").alias("max_risk"),
    )


def mean_by(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(column).alias(name))


def distinct_machines(mart: DataFrame) -> DataFrame:
    return mart.select("machine_id").distinct()


def risk_by_machine(mart: DataFrame) -> DataFrame:
    return mart.select("machine_id", "failure_risk_score", "health_status")


def risk_labels(mart: DataFrame) -> DataFrame:
    return mart.select("machine_id", "health_status", R.risk_label(F.col("health_status")).alias("risk_label"))


def sensor_averages(readings: DataFrame) -> DataFrame:
    return readings.groupBy("machine_id").agg(
        F.avg("temperature").alias("avg_temp"),
        F.avg("vibration").alias("avg_vibration"),
        F.avg("pressure").alias("avg_pressure"),
    )


def mart_vs_sensor_averages(mart: DataFrame, readings: DataFrame) -> DataFrame:
    """Health of each machine beside its sensor averages.

    Both sides are one row per machine before they meet.
    """
    return mart_vs_averages(mart, sensor_averages(readings))


def mart_vs_averages(mart: DataFrame, averages: DataFrame) -> DataFrame:
    """Health of each machine beside averages that were computed before."""
    return mart.select("machine_id", "health_status", "failure_risk_score").join(averages, "machine_id")


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation, NULL when a side is constant (`corr` raises there in ANSI mode).

    Only rows with both values count, on every factor.
    """
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def status_sensor_correlation(mart: DataFrame, readings: DataFrame) -> DataFrame:
    """One row: correlation of the health rank with each sensor average."""
    return status_average_correlation(mart, sensor_averages(readings))


def status_average_correlation(mart: DataFrame, averages: DataFrame) -> DataFrame:
    """As status_sensor_correlation, from averages that were computed before."""
    rank = R.status_rank(F.col("health_status"))
    return mart_vs_averages(mart, averages).agg(
        *[correlation(rank, F.col(c)).alias(f"corr_{c}") for c in ["avg_temp", "avg_vibration", "avg_pressure"]]
    )


def readings_without_mart(readings: DataFrame, mart: DataFrame) -> DataFrame:
    """One row: readings whose machine has no mart row. A NULL machine counts as missing.

    Readings are counted per machine first, so the join sees one row per machine. An outer join keeps
    that order; Spark would push an anti join below the counting, onto every reading.
    """
    per_machine = readings.groupBy("machine_id").agg(F.count("*").alias("n"))
    known = mart.select("machine_id", F.lit(True).alias("known"))
    missing = per_machine.join(known, "machine_id", "left").filter(F.col("known").isNull())
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("missing_readings"))


def mart_without_readings(mart: DataFrame, readings: DataFrame) -> DataFrame:
    """One row: mart rows whose machine has no reading."""
    machines = readings.select("machine_id").distinct()
    return mart.join(machines, "machine_id", "left_anti").agg(F.count("*").alias("orphaned_metrics"))
