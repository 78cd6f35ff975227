"""One run from new landing rows to history, mart, checks and alerts.

Every table takes the rows of a run (a load) in place of those the same load wrote before, so a run that is
repeated after a failure ends like one that did not fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.operators import alerts, kept, marts, quality
from millwatch.operators.history import load_history
from millwatch.operators.staging import staging_readings
from millwatch.sources.landing import good_rows, rejected_rows
from millwatch.sources.tables import DAY, LOAD, WHOLE, Store, publish_view

LANDING, REJECTS, HISTORY = "landing", "landing_rejects", "history"
TOTALS, MART, CHECKS = "machine_totals", "machine_health", "check_results"
ALERTS, CRITICAL = "alerts", "critical_machines"
DEDUPLICATED = "deduplicated"
KEY_COUNTS, DUPLICATE_KEYS, KEY_DAYS = "key_counts", "duplicate_keys", "key_days"
LANDING_KEY = ["machine_id", "timestamp"]
SENSOR_TOTALS, MACHINE_DAYS = "sensor_totals", "machine_days"
STAGING_VIEW = "staging_readings"


def land(store: Store, parsed: DataFrame, load: str) -> None:
    """Typed rows, with load time and file name where known, and rejected rows."""
    store.append(LANDING, good_rows(parsed), load)
    store.append(REJECTS, rejected_rows(parsed), load)


def build(store: Store, landing: DataFrame, load: str) -> None:
    """Bring history, mart and check results up to date with the landing rows of a load.

    Totals and check results of the load are added to the stored ones: the cost follows the load and the
    number of machines, not the length of the history.
    """
    load_history(landing, store, HISTORY, load)
    staging = staging_readings(store.load(HISTORY, load))
    store.append(TOTALS, marts.machine_totals(staging), load)
    store.replace(MART, marts.assess(marts.merge_totals(store.read(TOTALS))))
    store.append(CHECKS, quality.table_checks(landing, staging), load)


def rebuild(store: Store) -> None:
    """Totals, mart and check results from the whole tables, for use after an upsert, delete or restore."""
    staging = staging_readings(store.read(HISTORY))
    store.replace(TOTALS, marts.machine_totals(staging))
    store.replace(MART, marts.assess(marts.merge_totals(store.read(TOTALS))))
    if store.exists(SENSOR_TOTALS):
        keep_figures(store, store.read(HISTORY))
    if store.exists(LANDING):
        store.replace(CHECKS, quality.table_checks(store.read(LANDING), staging))


def fold_totals(store: Store, keep: str) -> None:
    """One row per machine for all loads but `keep`, the one that may yet be run again."""
    rows = store.read(TOTALS, with_folders=True)
    old = marts.merge_totals(rows.filter(F.col(LOAD) != keep).drop(DAY, LOAD)).withColumn(LOAD, F.lit(WHOLE))
    store.put_loads(TOTALS, old.unionByName(rows.filter(F.col(LOAD) == keep).drop(DAY)))


def keep_figures(store: Store, readings: DataFrame, load: str | None = None) -> None:
    """Add the sensor totals and machine sketches of a load's history rows to the stored ones; without a load, in place of all."""
    figures = {SENSOR_TOTALS: kept.sensor_totals(readings), MACHINE_DAYS: kept.machine_days(readings)}
    for name, rows in figures.items():
        store.replace(name, rows) if load is None else store.append(name, rows, load)


def fold_figures(store: Store, keep: str) -> None:
    """One row per machine, and per day, for all loads but `keep`, the one that may yet be run again."""
    for name, merge in ((SENSOR_TOTALS, kept.merge_sensor_totals), (MACHINE_DAYS, kept.merge_machine_days)):
        rows = store.read(name, with_folders=True)
        old = merge(rows.filter(F.col(LOAD) != keep).drop(DAY, LOAD)).withColumn(LOAD, F.lit(WHOLE))
        store.put_loads(name, old.unionByName(rows.filter(F.col(LOAD) == keep).drop(DAY)))


def keep_keys(store: Store, rows: DataFrame, load: str) -> None:
    """Bring the counts of landing keys, the repeated keys and the figures of each day up to date with the rows of a load.

    A key holds its time, so it lies in one day: only days that the load touches are counted again, from the counts of all
    loads, whatever the length of the history. Rows without a time share the missing day. A load that is run again takes the place of
    its earlier counts. Counts combine before the shuffle, so a key with most of the rows is no single task's work.
    """
    store.append(KEY_COUNTS, kept.key_counts(rows, LANDING_KEY), load)
    counts = store.read(KEY_COUNTS, with_folders=True)
    days = store.days(counts.filter(F.col(LOAD) == load))
    merged = kept.merge_key_counts(store.of_days(counts, days), LANDING_KEY)
    figures = kept.day_uniqueness(merged.withColumn("timestamp", F.date_trunc("day", "timestamp").cast("timestamp_ntz")), "timestamp")
    for name, part in ((DUPLICATE_KEYS, merged.filter(F.col("occurrences") > 1)), (KEY_DAYS, figures)):
        if not store.exists(name):
            store.create(name, part.schema)
        store.put_days(name, part, days)


def duplicate_keys(store: Store) -> DataFrame:
    """Landing keys with several rows over all loads, with their number, as kept."""
    return store.read(DUPLICATE_KEYS)


def uniqueness(store: Store) -> DataFrame:
    """One row for the whole landing table, from the kept figures of its days: rows, keys, repeated keys, rows beyond the first of their key."""
    names = ("n_rows", "n_keys", "repeated_keys", "surplus_rows")
    return store.read(KEY_DAYS).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))


def sensor_averages(store: Store) -> DataFrame:
    """Sensor averages per machine over all loads, from the stored totals."""
    return kept.averages(kept.merge_sensor_totals(store.read(SENSOR_TOTALS)))


def machines_between(store: Store, first: str | None = None, last: str | None = None) -> DataFrame:
    """One row: readings and about how many machines there are from day `first` to day `last`, from the stored sketches.

    None leaves a side open; without both, readings without a time count too.
    """
    days = store.read(MACHINE_DAYS)
    if first is not None:
        days = days.filter(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        days = days.filter(F.col("day") <= F.lit(last).cast("date"))
    return kept.machines_of(days)


def check_results(store: Store) -> DataFrame:
    """Every declared check on the whole tables: stored counts of landing and staging added up, and the mart as it is."""
    return quality.added_up(store.read(CHECKS)).unionByName(quality.mart_checks(store.read(MART)))


def run_batch(store: Store, landing: DataFrame, load: str, figures: bool = False) -> DataFrame:
    """Land and build, publish the staging view, and return the results of the declared checks on the whole tables.

    With `figures` the sensor totals and machine sketches of the load are kept too.
    """
    store.append(LANDING, landing, load)
    build(store, store.load(LANDING, load), load)
    if figures:
        keep_figures(store, store.load(HISTORY, load), load)
    publish_view(staging_readings(store.read(HISTORY)), STAGING_VIEW)
    return check_results(store)


def alert_pass(store: Store, load: str, batch: int, now: Column | None = None, parts: int = 1) -> None:
    """Evaluate the mart once: the critical machines, one row each, and the messages about them."""
    mart = store.read(MART)
    store.replace(CRITICAL, alerts.critical_entries(mart))
    messages = alerts.alert_messages(mart, F.current_timestamp() if now is None else now, parts)
    store.append(ALERTS, messages.withColumn("batch", F.lit(batch).cast("bigint")), load)
