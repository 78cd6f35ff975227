"""Dedup, bound, upsert and the stored tables behind them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.operators import history
from millwatch.plans import build as B
from millwatch.session import workspace
from millwatch.sources import snapshots
from millwatch.sources.tables import Store

LANDING = "machine_id string, timestamp timestamp_ntz, temperature double, vibration double, pressure double, status_code string"
T0 = datetime(2024, 5, 13, 10)
H = timedelta(hours=1)
DAY = timedelta(days=1)


def landing(spark, *rows):
    return spark.createDataFrame([(m, t, v, 0.1, 100.0, s) for m, t, v, s in rows], LANDING)


@pytest.fixture
def store(spark):
    return Store(spark, workspace(spark))


def keys(df):
    return sorted((r["machine_id"], r["event_time"]) for r in df.collect())


def test_dedup_takes_the_highest_payload(spark):
    df = landing(spark, ("M1", T0, 60.0, "AOK"), ("M1", T0, 70.0, "AOK"), ("M1", T0, 99.0, None), ("M2", T0, 1.0, "AOK"))
    rows = {r["machine_id"]: r["temperature"] for r in history.first_load(df).collect()}
    assert rows == {"M1": 70.0, "M2": 1.0}


def test_dedup_prefers_the_last_load(spark):
    df = spark.createDataFrame(
        [("M1", T0, 1.0, "WARN", T0), ("M1", T0, 2.0, "AOK", T0 + H)],
        "machine_id string, event_time timestamp_ntz, temperature double, status_code string, _loaded_at timestamp_ntz",
    )
    ranked = history.dedup_latest(df.withColumns({"vibration": F.lit(0.0), "pressure": F.lit(0.0)}))
    assert ranked.first()["temperature"] == 2.0


def test_bound_is_strict_global_and_drops_unknown_times(spark):
    stored = history.first_load(landing(spark, ("M1", T0, 60.0, "AOK"), ("M1", None, 60.0, "AOK")))
    assert stored.count() == 2  # the first load keeps a reading without a time
    later = landing(
        spark,
        ("M1", T0, 61.0, "AOK"),
        ("M9", T0 - H, 61.0, "AOK"),
        ("M1", None, 61.0, "AOK"),
        ("M1", T0 + H, 61.0, "AOK"),
    )
    assert keys(history.increment(later, stored)) == [("M1", T0 + H)]


def test_bound_of_an_empty_history(spark):
    empty = spark.createDataFrame([], schemas.HISTORY)
    assert history.high_water_mark(empty).first()[0] == datetime(1900, 1, 1)


def test_upsert_and_its_null_keys(spark):
    old = history.rename_cast(landing(spark, ("M1", T0, 1.0, "AOK"), ("M1", None, 1.0, "AOK"), ("M2", T0, 1.0, "AOK")))
    new = history.rename_cast(landing(spark, ("M1", T0, 2.0, "AOK"), ("M1", None, 2.0, "AOK")))
    rows = sorted((r["machine_id"], str(r["event_time"]), r["temperature"]) for r in history.upsert(old, new).collect())
    assert rows == [("M1", "2024-05-13 10:00:00", 2.0), ("M1", "None", 1.0), ("M1", "None", 2.0), ("M2", "2024-05-13 10:00:00", 1.0)]


def dated(spark, *rows):
    return history.rename_cast(landing(spark, *rows))


def files(store, name):
    return set(store.read(name).inputFiles())


def test_stored_upsert_rewrites_only_touched_days(spark, store):
    store.replace("t", dated(spark, ("M1", T0, 1.0, "AOK"), ("M2", T0, 1.0, "AOK"), ("M1", T0 + DAY, 1.0, "AOK")))
    before = {f for f in files(store, "t") if "event_date=2024-05-14" in f}
    store.upsert("t", dated(spark, ("M1", T0, 2.0, "AOK"), ("M3", T0 + 2 * DAY, 2.0, "AOK")), ["machine_id", "event_time"])
    assert before and before <= files(store, "t")
    rows = sorted((r["machine_id"], r["event_time"].day, r["temperature"]) for r in store.read("t").collect())
    assert rows == [("M1", 13, 2.0), ("M1", 14, 1.0), ("M2", 13, 1.0), ("M3", 15, 2.0)]


def test_stored_upsert_on_another_key(spark, store):
    store.replace("t", spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"))
    store.upsert("t", spark.createDataFrame([("a", 2), ("c", 2)], "k string, v int"), ["k"])
    assert sorted(map(tuple, store.read("t").collect())) == [("a", 2), ("b", 1), ("c", 2)]
    store.replace("dated", dated(spark, ("M1", T0, 1.0, "AOK")))
    with pytest.raises(ValueError):
        store.upsert("dated", dated(spark, ("M1", T0, 1.0, "AOK")), ["machine_id"])


def test_delete_keeps_rows_where_the_condition_is_unknown(spark, store):
    store.replace("t", dated(spark, ("M1", T0, 1.0, "AOK"), ("M1", None, 1.0, "AOK"), ("M2", T0, 1.0, "AOK"), ("M1", T0 - DAY, 1.0, "AOK")))
    untouched = {f for f in files(store, "t") if "event_date=2024-05-12" in f}
    store.delete_where("t", (F.col("machine_id") == "M1") & (F.col("event_time") >= F.lit(T0)), since="2024-05-13")
    assert keys_with_none(store.read("t")) == [("M1", "2024-05-12 10:00:00"), ("M1", "None"), ("M2", "2024-05-13 10:00:00")]
    assert untouched and untouched <= files(store, "t")
    now = files(store, "t")
    store.delete_where("t", F.col("machine_id") == "nobody")
    assert files(store, "t") == now
    store.delete_where("t", F.col("machine_id") == "M2")  # the day is empty now
    assert keys_with_none(store.read("t")) == [("M1", "2024-05-12 10:00:00"), ("M1", "None")]


def keys_with_none(df):
    return sorted((r["machine_id"], str(r["event_time"])) for r in df.collect())


def test_append_evolves_columns_and_repeats_loads(spark, store):
    store.append("t", spark.createDataFrame([(1, "x")], "a int, gone string"), "w-0")
    store.append("t", spark.createDataFrame([(2, 0.5)], "a int, new double"), "w-1")
    store.append("t", spark.createDataFrame([(2, 0.5)], "a int, new double"), "w-1")  # again
    assert store.read("t").columns == ["a", "new"]
    assert sorted(map(tuple, store.read("t").collect())) == [(1, None), (2, 0.5)]
    assert [r["a"] for r in store.load("t", "w-1").collect()] == [2]
    store.append("t", spark.createDataFrame([(3, "y")], "a int, gone string"), "w-2")
    assert sorted(map(tuple, store.read("t").collect())) == [(1, None), (2, None), (3, "y")]


def test_a_changed_type_is_cast_or_refused(spark, store):
    store.append("t", spark.createDataFrame([(1, "7"), (2, "8")], "a bigint, b string"), "w-0")
    store.append("t", spark.createDataFrame([(1.5, "9")], "a double, b string"), "w-1")
    assert sorted(map(tuple, store.read("t").collect())) == [(1.0, "7"), (1.5, "9"), (2.0, "8")]
    store.append("t", spark.createDataFrame([(2.5, "word")], "a double, b string"), "w-2")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store.append("t", spark.createDataFrame([(3.5, 1)], "a double, b int"), "w-3")
    assert store.read("t").count() == 4


def test_create_and_replace(spark, store):
    assert not store.exists("t")
    with pytest.raises(LookupError):
        store.read("t")
    store.replace("t", spark.range(3))
    store.create("t", schemas.LANDING)
    assert store.read("t").isEmpty() and store.read("t").schema == schemas.LANDING
    store.replace("t", spark.range(2))
    assert store.read("t").count() == 2


def test_backup_and_restore_of_days(spark, store):
    store.replace("t", dated(spark, ("M1", T0, 1.0, "AOK"), ("M2", T0 + DAY, 1.0, "AOK"), ("M1", T0, 1.0, "AOK")))
    days = ["2024-05-13"]
    snapshots.back_up(store, "t", "backup", days)
    store.delete_where("t", F.col("machine_id") == "M1")
    store.append("t", dated(spark, ("M3", T0, 1.0, "AOK")), "later")
    assert (store.read("t").count(), store.read("backup").count()) == (2, 2)
    lost = snapshots.missing_rows(store, "t", "backup", days).collect()
    assert [r["machine_id"] for r in lost] == ["M1", "M1"]
    snapshots.restore(store, "t", "backup", days)
    assert sorted(r["machine_id"] for r in store.read("t").collect()) == ["M1", "M1", "M2"]


def test_rows_left_in_parts(spark):
    rows = spark.createDataFrame([("a",)] * 25 + [("b",)] * 2 + [("c",)], "x string")
    gone = spark.createDataFrame([("a",)] * 4 + [("c",)] * 3, "x string")
    left = snapshots.all_but(rows, gone, copies=10).groupBy("x").count().collect()
    assert {r["x"]: r["count"] for r in left} == {"a": 21, "b": 2}


def test_small_loads_are_merged_but_for_the_last(spark, store):
    for i in range(5):
        store.append("t", dated(spark, (f"M{i}", T0, 1.0, "AOK")), f"w-{i}")
    rows = keys(store.read("t"))
    store.merge_loads("t", "w-4", at_least=4)
    assert store.read("t", with_folders=True).select("load_id").distinct().count() == 2
    store.append("t", dated(spark, ("M4", T0, 1.0, "AOK")), "w-4")  # the last load once more
    assert keys(store.read("t")) == rows


def test_folded_totals_give_the_same_mart(spark, store):
    for batch in range(3):
        B.build(store, landing(spark, ("M1", T0 + batch * H, 70.0 + batch, "AOK")), f"w-{batch}")
    mart = store.kept(store.read(B.MART)).collect()
    B.fold_totals(store, "w-2")
    B.build(store, landing(spark, ("M1", T0 + 2 * H, 72.0, "AOK")), "w-2")
    assert store.read(B.MART).collect() == mart and store.read(B.TOTALS).count() == 2


def test_newest_day_is_enough_for_the_bound(spark, store):
    store.append("t", dated(spark, ("M1", T0, 1.0, "AOK"), ("M1", T0 + DAY, 1.0, "AOK"), ("M1", None, 1.0, "AOK")), "w-0")
    store.append("t", dated(spark, ("M1", T0 + 2 * DAY, 1.0, "AOK")), "w-1")
    assert keys(store.before_load("t", "w-1")) == [("M1", T0 + DAY)]


def test_a_run_repeated_after_a_failure(spark, store):
    """The history has the load, totals and mart do not: the repetition catches up."""
    first = landing(spark, ("M1", T0, 95.0, "AOK"), ("M1", None, 95.0, "AOK"))
    second = landing(spark, ("M1", T0 + H, 60.0, "AOK"), ("M2", T0 + H, 60.0, "AOK"))
    for _ in range(2):
        B.build(store, first, "w-0")
    history.load_history(second, store, B.HISTORY, "w-1")
    for _ in range(2):
        B.build(store, second, "w-1")
    mart = {r["machine_id"]: r["total_readings"] for r in store.read(B.MART).collect()}
    assert mart == {"M1": 3, "M2": 1}
    assert store.read(B.HISTORY).count() == 4


def test_rebuild_equals_incremental(spark, store):
    for batch in range(3):
        rows = [(f"M{i}", T0 + batch * H + timedelta(minutes=i), 70.0 + i + batch, "AOK") for i in range(10)]
        B.build(store, landing(spark, *rows), f"w-{batch}")
    incremental = sorted(store.read(B.MART).collect())
    B.rebuild(store)
    assert sorted(store.read(B.MART).collect()) == incremental


def test_run_batch_publishes_the_view_and_reports_checks(spark, store):
    bad = landing(spark, ("M1", T0, 95.0, "AOK"), ("M2", T0, None, "ODD"))
    for _ in range(2):
        results = B.run_batch(store, bad, "w-0").collect()
    found = {(r["model"], r["check"], r["column"]): r["violations"] for r in results}
    assert found["landing", "not_null", "temperature"] == 1
    assert found["landing", "accepted_values", "status_code"] == 1
    assert sum(found.values()) == 2
    more = B.run_batch(store, landing(spark, ("M3", T0 + H, None, "AOK")), "w-1").collect()
    assert {(r["check"], r["column"]): r["violations"] for r in more if r["model"] == "landing"}["not_null", "temperature"] == 2
    assert spark.table(B.STAGING_VIEW).count() == 1
