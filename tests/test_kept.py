"""Figures kept by adding."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwatch.operators import kept, overview
from millwatch.plans import build as B
from millwatch.session import workspace
from millwatch.sources.tables import Store

T0 = datetime(2024, 5, 13, 10)
SCHEMA = "machine_id string, event_time timestamp_ntz, temperature double, vibration double, pressure double"


@pytest.fixture
def store(spark):
    return Store(spark, workspace(spark))


@pytest.fixture
def readings(spark):
    rows = [(f"M{i % 7}", T0 + timedelta(hours=5 * i), float(i), None if i % 3 else i / 2, None) for i in range(40)]
    return spark.createDataFrame([*rows, (None, T0, 1.0, 1.0, 1.0), ("M99", None, 2.0, 2.0, 2.0)], SCHEMA)


def bag(df):
    return sorted(map(str, df.collect()))


def test_totals_of_loads_add_up(store, readings):
    parts = [readings.filter(F.pmod(F.xxhash64("temperature"), F.lit(3)) == k) for k in range(3)]
    for k in (0, 1, 2, 1):  # a load that is run again adds nothing
        B.keep_figures(store, parts[k], f"load-{k}")
    whole = overview.sensor_averages(readings)
    assert bag(B.sensor_averages(store)) == bag(whole)
    B.fold_figures(store, "load-2")
    assert store.read(B.MACHINE_DAYS, with_folders=True).select("load_id").distinct().count() == 2
    assert bag(B.sensor_averages(store)) == bag(whole)
    row = B.machines_between(store).first()
    assert (row["n_readings"], row["n_machines"]) == (42, 8)
    B.keep_figures(store, parts[0])  # in place of all
    assert bag(B.sensor_averages(store)) == bag(overview.sensor_averages(parts[0]))


def test_ranges_of_days(store, readings):
    B.keep_figures(store, readings, "a")
    rows = readings.filter("event_time >= '2024-05-14' AND event_time < '2024-05-16'")
    row = B.machines_between(store, "2024-05-14", "2024-05-15").first()
    assert (row["n_readings"], row["n_machines"]) == (rows.count(), rows.select("machine_id").distinct().count())
    assert tuple(B.machines_between(store, "2030-01-01").first()) == (0, 0)
    assert B.machines_between(store, None, "2024-05-13").first()["n_readings"] == readings.filter("event_time < '2024-05-14'").count()


def test_sketches_keep_their_error(spark):
    many = spark.range(300_000).select(F.col("id").cast("string").alias("machine_id"), F.expr("timestamp_ntz'2024-05-13' + make_dt_interval(cast(id % 5 as int))").alias("event_time"))
    days = kept.merge_machine_days(kept.machine_days(many), kept.machine_days(many))
    assert abs(kept.machines_of(days).first()["n_machines"] - 300_000) <= kept.SKETCH_ERROR * 300_000
    assert all(abs(r["n"] - 60_000) <= kept.SKETCH_ERROR * 60_000 for r in days.select(F.hll_sketch_estimate("machines").alias("n")).collect())


def landed(spark, *rows):
    return spark.createDataFrame(list(rows), "machine_id string, timestamp timestamp_ntz, temperature double")


def test_repeated_keys_are_kept_over_loads(spark, store):
    day = timedelta(days=1)
    loads = {
        "a": [("M1", T0, 1.0), ("M1", T0, 2.0), ("M2", T0, 1.0), ("M3", T0 + day, 1.0), (None, T0, 1.0)],
        "b": [("M2", T0, 5.0), ("M4", T0 + 2 * day, 1.0), ("M5", None, 1.0), (None, T0, 2.0)],
        "c": [("M5", None, 2.0), ("M6", None, 1.0)],
    }
    seen = []
    for load in ("a", "b", "b", "c"):
        B.keep_keys(store, landed(spark, *loads[load]), load)
        seen = seen if load == "b" and len(seen) > 5 else seen + loads[load]
        counts = {}
        for machine, at, _ in seen:
            counts[machine, at] = counts.get((machine, at), 0) + 1
        found = {(r["machine_id"], r["timestamp"]): r["occurrences"] for r in B.duplicate_keys(store).collect()}
        assert found == {k: n for k, n in counts.items() if n > 1}
        repeated = sum(n > 1 for n in counts.values())
        assert tuple(B.uniqueness(store).first()) == (len(seen), len(counts), repeated, len(seen) - len(counts))


def test_a_load_of_one_day_reads_and_writes_that_day_only(spark, store):
    day = timedelta(days=1)
    B.keep_keys(store, landed(spark, *((f"M{i % 3}", T0 + (i % 5) * day, 1.0) for i in range(30))), "a")
    before = store.read(B.DUPLICATE_KEYS).inputFiles()
    B.keep_keys(store, landed(spark, ("M0", T0, 1.0), ("M9", T0, 1.0)), "b")
    gone = set(before) - set(store.read(B.DUPLICATE_KEYS).inputFiles())
    assert gone and all("event_date=2024-05-13" in path for path in gone)
    assert store.read(B.DUPLICATE_KEYS).where("machine_id = 'M0' AND timestamp = '2024-05-13 10:00:00'").first()["occurrences"] == 3


def test_no_keys(spark, store):
    B.keep_keys(store, landed(spark), "a")
    assert B.duplicate_keys(store).isEmpty() and tuple(B.uniqueness(store).first()) == (0, 0, 0, 0)


def test_empty_tables(store, readings):
    B.keep_figures(store, readings.limit(0), "a")
    assert B.sensor_averages(store).isEmpty() and tuple(B.machines_between(store).first()) == (0, 0)
