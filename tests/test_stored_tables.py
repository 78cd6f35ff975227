"""Stored tables whose writes die, and readers beside a writer."""

import pathlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwatch.plans import build as B
from millwatch.session import children, workspace
from millwatch.sources import snapshots, tables
from millwatch.sources.tables import Store
from millwatch.streaming import jobs

T0 = datetime(2024, 5, 13, 10)
DAY = timedelta(days=1)
SCHEMA = "machine_id string, event_time timestamp_ntz, temperature double"


@pytest.fixture
def store(spark):
    return Store(spark, workspace(spark))


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def loaded(store, spark):
    """Three loads: two days and a row without a time."""
    store.append("t", rows(spark, ("M1", T0, 1.0), ("M2", T0 + DAY, 2.0)), "a")
    store.append("t", rows(spark, ("M3", T0, 3.0), ("M4", None, 4.0)), "b")
    store.append("t", rows(spark, ("M5", T0, 5.0)), "c")


def content(store, name="t"):
    return sorted((r["machine_id"], str(r["event_time"]), r["temperature"]) for r in store.read(name).collect())


CHANGES = {
    "upsert": lambda s, spark: s.upsert("t", rows(spark, ("M1", T0, 9.0), ("M6", T0 + DAY, 6.0)), ["machine_id", "event_time"]),
    "delete_where": lambda s, spark: s.delete_where("t", F.col("temperature") >= 3),
    "put_days": lambda s, spark: s.put_days("t", rows(spark, ("M7", T0, 7.0)), ["2024-05-13", None]),
    "put_loads": lambda s, spark: s.put_loads("t", s.read("t", with_folders=True).where("event_time IS NULL").drop("event_date")),
    "merge_loads": lambda s, spark: s.merge_loads("t", "c", 2),
    "append_of_other_columns": lambda s, spark: s.append("t", rows(spark, ("M8", T0, 8.0)).withColumn("temperature", F.col("temperature").cast("string")), "d"),
    "replace": lambda s, spark: s.replace("t", rows(spark, ("M9", T0, 9.0))),
}


@pytest.mark.parametrize("stage", ["before the record", "folders gone", "half written", "record left"])
@pytest.mark.parametrize("name", ["upsert", "delete_where", "put_days", "put_loads", "merge_loads"])
def test_a_killed_change_of_days_loses_nothing(spark, store, monkeypatch, name, stage):
    loaded(store, spark)
    before = content(store)
    twin = Store(spark, workspace(spark))
    loaded(twin, spark)
    CHANGES[name](twin, spark)
    after = content(twin)

    fill, put = Store._fill, Store._put_days

    def dies(self, table, change):
        if stage == "half written":
            fill(self, table, {**change, "days": change["days"][:1]})
        elif stage == "record left":
            fill(self, table, change)
        else:
            monkeypatch.setattr(Store, "_write", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
            fill(self, table, change)
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        if stage == "before the record":
            m.setattr(Store, "_put_days", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        else:
            m.setattr(Store, "_fill", dies)
        write = Store._write
        with pytest.raises(RuntimeError, match="killed"):
            CHANGES[name](store, spark)
        monkeypatch.setattr(Store, "_write", write)
    assert Store._fill is fill and Store._put_days is put
    assert content(store) == (before if stage == "before the record" else after)  # readers already see what it will be
    CHANGES[name](Store(spark, store.root), spark)  # the same call by a new process
    assert content(store) == after
    assert children(spark, f"{store.root}/redo") == []


@pytest.mark.parametrize("name", ["append_of_other_columns", "replace"])
def test_a_killed_rebuild_changes_nothing(spark, store, monkeypatch, name):
    loaded(store, spark)
    before = content(store)
    with monkeypatch.context() as m:
        m.setattr(Store, "_set_schema", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            CHANGES[name](store, spark)
    assert content(store) == before
    CHANGES[name](store, spark)
    assert len(store.read("t").columns) == 3
    assert [r[0] for r in content(store)] == (["M9"] if name == "replace" else ["M1", "M2", "M3", "M4", "M5", "M8"])


def typed(spark, columns, *data):
    return spark.createDataFrame(list(data), "machine_id string, event_time timestamp_ntz, " + columns)


def files(store, name="t"):
    """Every stored file with its size and time."""
    base = pathlib.Path(f"{store.root}/{name}".removeprefix("file:"))
    return {(str(p), p.stat().st_size, p.stat().st_mtime_ns) for p in base.rglob("*.parquet")}


def test_schemas_per_load_rewrite_nothing(spark, store):
    steps = [
        ("a", typed(spark, "n bigint, site string", ("M1", T0, 7, "x"), ("M2", None, None, "y"))),
        ("b", typed(spark, "n double", ("M3", T0, 1.5))),  # a column goes, another changes its type
        ("c", typed(spark, "n double, site string", ("M4", T0 + DAY, 2.5, "z"))),  # it comes back
        ("d", typed(spark, "n string, site string, more int", ("M5", T0, "word", None, 5))),
        ("e", typed(spark, "more int, n string", ("M6", T0 + DAY, 6, "7"))),  # other order
    ]
    stored = set()
    for load, df in steps:
        store.append("t", df, load)
        assert stored <= files(store)
        stored = files(store)
        assert store.read("t").schema.names == df.schema.names
        assert store.read("t").dtypes == df.dtypes
    got = sorted((r["machine_id"], r["n"], r["more"]) for r in Store(spark, store.root).read("t").collect())
    assert got == [("M1", "7.0", None), ("M2", None, None), ("M3", "1.5", None), ("M4", "2.5", None), ("M5", "word", 5), ("M6", "7", 6)]
    assert [r["machine_id"] for r in store.load("t", "b").collect()] == ["M3"]


def test_days_of_all_shapes_change_together(spark, store):
    store.append("t", typed(spark, "n bigint, gone int", ("M1", T0, 1, 1), ("M2", T0 + DAY, 2, 2), ("M3", None, 3, 3)), "a")
    store.append("t", typed(spark, "n double", ("M4", T0, 4.5)), "b")
    store.upsert("t", typed(spark, "n double", ("M1", T0, 9.5)), ["machine_id", "event_time"])
    assert [(r[0], r[2]) for r in sorted(store.read("t").collect())] == [("M1", 9.5), ("M2", 2.0), ("M3", 3.0), ("M4", 4.5)]
    store.delete_where("t", F.col("n") < 3)
    store.merge_loads("t", "none", 1)
    assert [(r[0], r[2]) for r in sorted(store.read("t").collect())] == [("M1", 9.5), ("M3", 3.0), ("M4", 4.5)]
    assert not [p for p, _, _ in files(store) if "/00000001/" in p]  # nothing is left of the first shape


def test_a_load_of_an_earlier_shape_is_run_again(spark, store, monkeypatch):
    store.append("t", typed(spark, "n bigint, gone int", ("M1", T0, 1, 1), ("M2", T0 + DAY, 2, 2)), "a")
    store.append("t", typed(spark, "n bigint, gone int", ("M3", T0, 3, 3)), "b")
    store.append("t", typed(spark, "n bigint", ("M4", T0, 4)), "c")
    again = typed(spark, "n bigint", ("M1", T0, 10))
    with monkeypatch.context() as m:
        m.setattr(Store, "_fill", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            store.append("t", again, "a")
    after = [("M1", 10), ("M3", 3), ("M4", 4)]
    for _ in range(2):
        assert [(r[0], r[2]) for r in sorted(store.read("t").collect())] == after
        store.append("t", again, "a")
    assert sorted(r[0] for r in store.load("t", "a").collect()) == ["M1"]


def test_many_shapes_become_one(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "SHAPES", 3)
    for i in range(8):
        kind = "bigint" if i % 2 else "string"
        store.append("t", typed(spark, f"n {kind}", (f"M{i}", T0, i if i % 2 else str(i))), f"l-{i}")
        assert len({number for number, _ in store._steps("t")}) <= 3
    assert [int(r["n"]) for r in sorted(store.read("t").collect())] == list(range(8))
    assert len(children(spark, f"{store.root}/schemas/t")) <= 3 * (tables.GENERATIONS + 2)


def test_a_column_of_all_shapes_is_pruned_by_day(spark, store):
    store.append("t", typed(spark, "n bigint", ("M1", T0, 1), ("M2", T0 + DAY, 2)), "a")
    store.append("t", typed(spark, "n double", ("M3", T0, 3.0), ("M4", T0 + DAY, 4.0)), "b")
    rows = store.of_days(store.read("t", with_folders=True), ["2024-05-13"]).select("machine_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan
    assert "ReadSchema: struct<machine_id:string>" in plan
    assert sorted(r[0] for r in rows.collect()) == ["M1", "M3"]


def test_a_first_load_that_dies_is_no_table(spark, store, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(Store, "_set_schema", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.append("t", rows(spark, ("M1", T0, 1.0)), "a")
    assert not store.exists("t")
    store.append("t", rows(spark, ("M2", T0, 2.0)), "b")
    assert [r[0] for r in content(store)] == ["M2"]


def test_a_reader_planned_before_a_replace_ends_with_the_old_rows(spark, store):
    store.replace("t", rows(spark, ("M1", T0, 1.0)))
    planned = store.read("t")
    for n in range(3):
        store.replace("t", rows(spark, (f"N{n}", T0, 1.0)))
    assert [r["machine_id"] for r in planned.collect()] == ["M1"]
    assert [r[0] for r in content(store)] == ["N2"]
    store.replace("t", store.read("t").withColumn("temperature", F.lit(2.0)))  # a table may be rebuilt from itself
    for n in range(12):
        store.replace("t", store.read("t"))
    assert content(store)[0][2] == 2.0
    assert len(children(spark, f"{store.root}/t")) <= 6


def test_backups_survive_a_killed_restore(spark, store, monkeypatch):
    loaded(store, spark)
    whole = content(store)
    snapshots.back_up(store, "t", "backup", ["2024-05-13"])
    store.delete_where("t", F.col("machine_id") == "M1")
    with monkeypatch.context() as m:
        m.setattr(Store, "_fill", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            snapshots.restore(store, "t", "backup", ["2024-05-13"])
    store.append("t", rows(spark, ("M6", T0 + DAY, 6.0)), "d")  # the next change ends the restore first
    assert content(store) == sorted([*whole, ("M6", str(T0 + DAY), 6.0)])


def test_build_and_alert_schedule_share_a_store(spark, tmp_path):
    """The mart is replaced in every micro-batch while the schedule reads it."""
    folder, root = tmp_path / "landing", str(tmp_path / "tables")
    folder.mkdir()
    store = Store(spark, root)

    def land(n):
        (folder / f"{n}.csv").write_text(f"machine_id,timestamp,temperature,vibration,pressure,status_code\nM{n},2024-05-13T10:00:{n:02d}Z,95,0.9,99.6,AOK\n")

    land(1)
    build = jobs.stream_build(store, str(folder), str(tmp_path / "build"), trigger={"processingTime": "1 second"})
    clock = None
    try:
        jobs.await_batch(build, 120)
        clock = jobs.alert_schedule(Store(spark, root), str(tmp_path / "alerts"), every="1 second")
        for n in range(2, 5):
            land(n)
            build.processAllAvailable()
        jobs.await_batch(clock, 120)
        assert build.exception() is None and clock.exception() is None and build.isActive and clock.isActive
    finally:
        build.stop()
        if clock is not None:
            clock.stop()
    assert store.read(B.MART).count() == 4
    assert store.read(B.ALERTS).where("should_send").count() >= 1
