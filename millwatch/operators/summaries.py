"""Labelled table summaries, profiles and small lookups over readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch import settings as S


def table_summary(readings: DataFrame, label: str) -> DataFrame:
    """One labelled row of totals, in one aggregation."""
    return readings.agg(
        F.lit(label).alias("checkpoint"),
        F.count("*").alias("total_records"),
        F.count_distinct("machine_id").alias("unique_machines"),
        F.min("timestamp").alias("earliest_reading"),
        F.max("timestamp").alias("latest_reading"),
        F.avg("temperature").alias("avg_temperature"),
        F.count_if(F.col("status_code") == "CRIT").alias("critical_alerts"),
        F.count_if(F.col("temperature") > 200).alias("corrupted_temps"),
    )


def checkpoint_report(versions: dict[str, DataFrame]) -> DataFrame:
    """The summary of each labelled version, one row each."""
    return reduce(DataFrame.unionByName, [table_summary(df, label) for label, df in versions.items()])


def machines_record_count(readings: DataFrame, ids: list[str]) -> DataFrame:
    """Records, machines, and records of the given machines."""
    return readings.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("machine_id").alias("unique_machines"),
        F.count_if(F.col("machine_id").isin(ids)).alias("selected_records"),
    )


def per_machine_summary(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("machine_id")
        .agg(
            F.count("*").alias("record_count"),
            F.min("timestamp").alias("earliest_reading"),
            F.max("timestamp").alias("latest_reading"),
            F.avg("temperature").alias("avg_temp"),
        )
        .orderBy("machine_id")
    )


def null_profile(readings: DataFrame, label: str = S.PROFILE_LABEL) -> DataFrame:
    """NULLs per checked column, machines and time range, in one aggregation."""
    return readings.agg(
        F.lit(label).alias("check_type"),
        F.count("*").alias("total_records"),
        F.count_distinct("machine_id").alias("unique_machines"),
        F.count_if(F.col("temperature").isNull()).alias("null_temperatures"),
        F.count_if(F.col("vibration").isNull()).alias("null_vibrations"),
        F.count_if(F.col("status_code").isNull()).alias("null_status_codes"),
        F.min("timestamp").alias("earliest_reading"),
        F.max("timestamp").alias("latest_reading"),
    )


def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column values that occur in more than one row, with their number."""
    counted = df.groupBy(*columns).agg(F.count("*").alias("occurrences"))
    return counted.filter(F.col("occurrences") > 1)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value.

    The total comes from the grouped counts, whose shuffle both uses share.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def machines_since(readings: DataFrame, ids: list[str], since: Column) -> DataFrame:
    return readings.filter(F.col("machine_id").isin(ids) & (F.col("timestamp") >= since))


def recent_readings(readings: DataFrame, n: int) -> DataFrame:
    """The n latest readings over all machines, latest first; a missing time counts as latest.

    Equal times are ordered by all other columns, so the result is determined up to equal rows.
    """
    others = [c for c in ["machine_id", *S.SENSORS, "status_code"] if c in readings.columns]
    return readings.orderBy(F.col("timestamp").desc_nulls_first(), *others).limit(n)


def days_of_recent(dated: DataFrame, n: int, day: str = "event_date") -> DataFrame:
    """The newest days of a table partitioned by `day` that hold n rows, and the rows without a day.

    The day to begin with comes from the numbers of rows per day, which need no column of the files, and
    reaches the listing of folders as a filter on the partition.
    """
    days = dated.filter(F.col(day).isNotNull()).groupBy(day).agg(F.count("*").alias("n"))
    later = Window.orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = days.withColumn("later", F.coalesce(F.sum("n").over(later), F.lit(0))).filter(F.col("later") < n)
    first = needed.agg(F.coalesce(F.min(day), F.lit("0001-01-01").cast("date")).alias("first"))
    return dated.filter((F.col(day) >= first.scalar()) | F.col(day).isNull())


def recent_for(readings: DataFrame, ids: list[str], n: int = 10) -> DataFrame:
    return recent_readings(readings.filter(F.col("machine_id").isin(ids)), n)


def label(df: DataFrame, text: str, name: str = "source") -> DataFrame:
    return df.select(F.lit(text).alias(name), "*")


def sample(df: DataFrame, n: int) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def sampled_from(rows: DataFrame, source: DataFrame) -> DataFrame:
    """One row: how many rows a sample has, and how many of them are rows of the source."""
    same = [rows[c].eqNullSafe(source[c]) for c in rows.columns]
    found = rows.join(source, same, "left_semi")
    return rows.agg(F.count("*").alias("n_rows")).withColumn("n_from_source", found.agg(F.count("*")).scalar())


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("record_count"))


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Equality filter (one machine, one status)."""
    return df.filter(F.col(column) == value)
