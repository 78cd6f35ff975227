"""Deduplicated, incremental reading history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch import settings as S
from millwatch.sources.tables import Store


def rename_cast(landing: DataFrame) -> DataFrame:
    """Landing columns with the time as wall-clock `event_time`."""
    return landing.select(
        "machine_id",
        F.col("timestamp").try_cast("timestamp_ntz").alias("event_time"),
        *S.SENSORS,
        "status_code",
    )


def high_water_mark(history: DataFrame) -> DataFrame:
    """One row `last_time`: the latest stored time, or the sentinel for an empty history."""
    sentinel = F.lit(S.FIRST_EVENT_TIME).cast("timestamp_ntz")
    return history.agg(F.coalesce(F.max("event_time"), sentinel).alias("last_time"))


def after_high_water_mark(readings: DataFrame, bound: DataFrame) -> DataFrame:
    """Readings strictly later than the bound, which is one for all machines. NULL times drop out.

    As a scalar subquery the bound reaches the file scan as a pushed filter; no join is planned.
    """
    return readings.filter(F.col("event_time") > bound.select("last_time").scalar())


def dedup_latest(readings: DataFrame, keys: list[str] = S.HISTORY_KEY) -> DataFrame:
    """One row per key: the one loaded last, ties broken by the payload so that the winner is fixed.

    Spark ranks within each input partition first (WindowGroupLimit), so even a key repeated in a
    third of all rows sends one candidate per task through the shuffle.
    """
    ranking = [c for c in ["_loaded_at", "status_code", *S.SENSORS] if c in readings.columns]
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ranking])
    return (
        readings.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") == 1).drop("rn")
    )


def first_load(landing: DataFrame) -> DataFrame:
    """History rows of a first run. Readings without a time are kept."""
    return dedup_latest(rename_cast(landing)).withColumn("_loaded_at", F.current_timestamp())


def increment(landing: DataFrame, history: DataFrame) -> DataFrame:
    """History rows of a later run: only what lies beyond everything stored before the run."""
    fresh = after_high_water_mark(rename_cast(landing), high_water_mark(history))
    return dedup_latest(fresh).withColumn("_loaded_at", F.current_timestamp())


def upsert(target: DataFrame, source: DataFrame, keys: list[str] = S.HISTORY_KEY) -> DataFrame:
    """Target rows without a counterpart in the source, and all source rows."""
    return sync_columns(target.join(source.select(*keys), keys, "left_anti"), source).unionByName(source)


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target in the columns of the source: new ones are NULL, vanished ones are dropped."""
    columns: list[Column] = [
        F.col(f.name) if f.name in target.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in source.schema
    ]
    return target.select(*columns)


def load_history(landing: DataFrame, store: Store, name: str, load: str) -> None:
    """Add the landing rows of a load to the stored history.

    Beyond the strict bound no key can already be stored, so the merge on the key is an append. The bound
    comes from the latest day stored before this load alone.
    """
    if store.exists(name) and not (before := store.before_load(name, load)).isEmpty():
        rows = increment(landing, before)
    else:
        rows = first_load(landing)
    store.append(name, rows, load)
