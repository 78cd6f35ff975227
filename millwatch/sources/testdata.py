"""Machine readings derived from the `events` test table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import settings as S


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def detail_number(events: DataFrame) -> Column:
    """The integer `k` of the event's one-member properties `{"k": 69}`, which selects planted faults.

    It stands in most derived columns and in the filters on them, where Spark evaluates it anew for every
    mention. Cutting the text is several times cheaper than parsing JSON.
    """
    after_colon = F.substring_index(events["props"], ":", -1)
    return F.substring_index(after_colon, "}", 1).try_cast("int")


def machine_id(user_id: Column) -> Column:
    """`M` and the id padded to five digits. Longer ids stay whole: a fixed pad would cut them."""
    digits = user_id.cast("string")
    return F.concat(F.lit("M"), F.lpad(digits, F.greatest(F.lit(5), F.length(digits)), F.lit("0")))


def readings_with_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows plus `event_id` and `k`."""
    events = read_events(spark, sf_dir)
    k = F.col("k")
    error = F.col("event_type") == "error"
    return events.withColumn("k", detail_number(events)).select(
        "event_id",
        "k",
        machine_id(F.col("user_id")).alias("machine_id"),
        F.col("ts").alias("timestamp"),
        F.when(k == 0, -1.0)
        .when(k == 4, None)
        .otherwise(60.0 + F.col("value") / 4.0)
        .alias("temperature"),
        F.when(k == 1, -0.5).otherwise(F.col("value") / 400.0).alias("vibration"),
        F.when(k == 2, 460.0)
        .when(k == 3, 510.0)
        .otherwise((93 + k % 15).cast("double"))
        .alias("pressure"),
        F.when(error & (k < 20), "CRIT")
        .when(error, "WARN")
        .when((F.col("event_type") == "signup") & (k == 5), "FAULT")
        .otherwise("AOK")
        .alias("status_code"),
    )


def readings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole `events` table in the landing schema."""
    return readings_with_detail(spark, sf_dir).select(
        "machine_id", "timestamp", *S.SENSORS, "status_code"
    )


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with times cut to the hour, which gives repeated (machine, time) keys."""
    time = F.col("timestamp")
    hour = F.to_date(time).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(time))
    return readings_from_events(spark, sf_dir).withColumn("timestamp", hour)
