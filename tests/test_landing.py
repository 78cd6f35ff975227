"""Landing files: parsing, rejects, batches, streams."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.operators import quality, summaries
from millwatch.plans import build as B
from millwatch.session import workspace
from millwatch.sources import batches, landing
from millwatch.sources.tables import Store
from millwatch.streaming import jobs

HEADER = "machine_id,timestamp,temperature,vibration,pressure,status_code"


def write(folder, name, *lines):
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def test_good_and_bad_rows(spark, tmp_path):
    write(
        tmp_path, "a.csv",
        "M001,2024-05-13T10:00:04Z,65.3,0.02,99.6,AOK",
        "M002,2024-05-13T10:00:05Z,NULL,null,,WARN",
        "M003,2024-05-13T10:00:06Z,hot,0.02,99.6,AOK",
        "M004,yesterday,65.3,0.02,99.6,AOK",
        "M005,2024-05-13T10:00:07Z,65.3",
        "M006,2024-05-13T10:00:07Z,65.3,0.02,99.6,AOK,extra",
        "M" + "7" * 50 + ",2024-05-13T10:00:07Z,65.3,0.02,99.6,AOK",
        "M008,2024-05-13T10:00:08Z,65.3,0.02,99.6,MUCHTOOLONG",
        "M009,2024-05-13T10:00:09Z,1d,0.02,99.6,AOK",
        'M010,2024-05-13T10:00:10Z,65.3,0.02,99.6,"AOK"',
    )
    (tmp_path / "notes.txt").write_text("not a landing file\n")
    good, bad = landing.copy_into(landing.read_landing_csv(spark, str(tmp_path)))
    assert good.schema == schemas.LANDING
    rows = {r["machine_id"]: r for r in good.collect()}
    assert sorted(rows) == ["M001", "M002", "M010"]
    assert rows["M001"]["timestamp"] == datetime(2024, 5, 13, 10, 0, 4)
    assert (rows["M002"]["temperature"], rows["M002"]["vibration"], rows["M002"]["pressure"]) == (None,) * 3
    assert rows["M010"]["status_code"] == '"AOK"'  # quotes are plain characters
    reasons = {r["raw_line"][:4]: r["reject_reason"] for r in bad.collect()}
    assert reasons == {
        "M003": "temperature", "M004": "timestamp", "M005": "cells", "M006": "cells",
        "M777": "machine_id", "M008": "status_code", "M009": "temperature",
    }


def test_wrong_separator_loads_nothing_and_is_noticed(spark, tmp_path):
    write(tmp_path, "a.csv", "M001,2024-05-13T10:00:04Z,65.3,0.02,99.6,AOK")
    good, bad = landing.copy_into(landing.read_landing_csv(spark, str(tmp_path), sep=";"))
    assert (good.count(), bad.count()) == (0, 1)
    assert quality.not_empty(good, "landing").first()["violations"] == 1


def test_the_rejected_line_is_the_line(spark, tmp_path):
    lines = ["M1;yesterday;65.3;;99.6;AOK", "M2;2024-05-13T10:00:04Z;65.3", "M3;2024-05-13T10:00:04Z;hot;0.1;1;AOK"]
    (tmp_path / "a.csv").write_text("\n".join([HEADER.replace(",", ";"), *lines]) + "\n")
    _, bad = landing.copy_into(landing.read_landing_csv(spark, str(tmp_path), sep=";"), ";")
    assert sorted(r["raw_line"] for r in bad.collect()) == sorted(lines)


def test_provenance(spark, tmp_path):
    write(tmp_path, "a.csv", "M001,2024-05-13T10:00:04Z,65.3,0.02,99.6,AOK")
    row = landing.with_provenance(landing.read_landing_csv(spark, str(tmp_path))).first()
    assert row["_file_name"] == "a.csv" and row["_loaded_at"] is not None


def test_latest_batch_compares_numbers(spark, tmp_path):
    for name in ["sensor_data_batch_0.csv", "sensor_data_batch_2.csv", "sensor_data_batch_10.csv", "other.csv"]:
        write(tmp_path, name)
    (tmp_path / "sensor_data_batch_99.txt").write_text("")
    files = batches.list_landing_files(spark, str(tmp_path))
    assert files.count() == 4
    assert batches.latest_batch(files).collect() == [(10, "sensor_data_batch_10.csv")]
    only_zero = files.filter(F.col("path").contains("batch_0"))
    assert batches.latest_batch(only_zero).isEmpty()


def test_resume_point(spark, tmp_path):
    assert tuple(batches.batch_resume_point(spark, str(tmp_path)).first()) == (1, None)
    write(tmp_path, "sensor_data_batch_1.csv", "M001,2024-05-13T12:00:00Z,65.3,0.02,99.6,AOK")
    write(
        tmp_path, "sensor_data_batch_2.csv",
        "M001,2024-05-13T11:10:35Z,65.3,0.02,99.6,AOK",
        "M002,2024-05-13T11:10:14Z,65.3,0.02,99.6,AOK",
    )
    by_row = batches.batch_resume_point(spark, str(tmp_path)).first()
    by_time = batches.batch_resume_point(spark, str(tmp_path), order="time").first()
    assert tuple(by_row) == (3, datetime(2024, 5, 13, 11, 10, 14))
    assert tuple(by_time) == (3, datetime(2024, 5, 13, 11, 10, 35))


def test_new_files_and_run_key(spark):
    def paths(*names):
        return spark.createDataFrame([(n,) for n in names], "path string")

    fresh = batches.new_files(paths("b", "c", "a"), paths("a", "gone"))
    assert batches.run_key(fresh).first()[0] == "s3_files_b_c"
    # A file that left and came back is new again: the cursor is the last listing, not all of them.
    assert batches.new_files(paths("a"), paths("b", "c")).count() == 1
    assert batches.run_key(paths().limit(0)).first()[0] is None


def test_the_cursor_is_the_last_listing(spark):
    store = Store(spark, workspace(spark))

    def listing(*names):
        return spark.createDataFrame([(n,) for n in names], "path string")

    assert batches.take_new(store, listing("a", "b")).count() == 2
    assert batches.take_new(store, listing("a", "b")).isEmpty()
    assert [r["path"] for r in batches.take_new(store, listing("b", "c")).collect()] == ["c"]
    assert [r["path"] for r in batches.take_new(store, listing("a", "b")).collect()] == ["a"]  # it came back


@pytest.fixture
def stream(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    store = Store(spark, workspace(spark))
    return folder, store, str(tmp_path / "checkpoint")


def run(store, folder, checkpoint, with_alerts=True, **options):
    options["with_alerts"] = with_alerts
    jobs.stream_build(store, str(folder), checkpoint, trigger={"availableNow": True}, **options).awaitTermination()


def test_stream_drops_what_is_not_later_than_the_last_batch(spark, stream):
    folder, store, checkpoint = stream
    write(folder, "1.csv", "M1,2024-05-13T10:00:05Z,65,0.02,99.6,AOK", "M1,2024-05-13T10:00:10Z,95,0.9,99.6,AOK")
    run(store, folder, checkpoint)
    write(
        folder, "2.csv",
        "M2,2024-05-13T10:00:09Z,65,0.02,99.6,AOK",
        "M1,2024-05-13T10:00:10Z,65,0.02,99.6,AOK",
        "M1,2024-05-13T10:00:11Z,65,0.02,99.6,AOK",
        "broken",
    )
    run(store, folder, checkpoint)
    run(store, folder, checkpoint)  # nothing new
    seconds = sorted(r["event_time"].second for r in store.read(B.HISTORY).collect())
    assert seconds == [5, 10, 11]
    assert store.read(B.LANDING).count() == 5
    assert store.read(B.REJECTS).count() == 1
    mart = store.read(B.MART).collect()
    assert [(r["machine_id"], r["total_readings"], r["health_status"]) for r in mart] == [("M1", 3, "CRITICAL")]
    alerts = store.read(B.ALERTS)
    assert sorted(r["batch"] for r in alerts.collect()) == [0, 1]
    assert alerts.first()["machines_data"] == "M1|90|Immediate maintenance required"


def test_stream_of_single_files_equals_batch_runs(spark, stream):
    folder, store, checkpoint = stream
    lines = [f"M{i % 3},2024-05-13T10:00:{i:02d}Z,{60 + i},0.02,99.6,AOK" for i in range(12)]
    other = Store(spark, workspace(spark))
    for n in range(3):
        part = lines[n * 4 : n * 4 + 4][::-1] + lines[n * 4 - 1 : n * 4]
        write(folder, f"{n}.csv", *part)
        raw = landing.read_landing_csv(spark, str(folder / f"{n}.csv"))
        B.build(other, landing.copy_into(raw)[0], f"batch-{n}")
        run(store, folder, checkpoint, with_alerts=False, max_files_per_trigger=1)
    for name in (B.HISTORY, B.MART):
        got, want = store.read(name), other.read(name)
        assert sorted(got.drop("_loaded_at").collect()) == sorted(want.drop("_loaded_at").collect())


def test_a_backlog_of_many_files_is_not_late_to_itself(spark, stream):
    folder, store, checkpoint = stream
    write(folder, "first.csv", *(f"M{i},2024-05-13T11:00:00Z,65,0.02,99.6,AOK" for i in range(3)))
    os.utime(folder / "first.csv", (1_700_000_000, 1_700_000_000))
    for n in range(jobs.FILES_PER_BATCH - 1):
        write(folder, f"empty-{n}.csv")
        os.utime(folder / f"empty-{n}.csv", (1_700_000_100, 1_700_000_100))
    write(folder, "last.csv", "M1,2024-05-13T10:00:00Z,65,0.02,99.6,AOK", "M2,,65,0.02,99.6,AOK")
    run(store, folder, checkpoint, with_alerts=False)
    hours = sorted(str(r["event_time"])[11:13] for r in store.read(B.HISTORY).collect())
    assert hours == ["", "10", "11", "11", "11"]


def test_streams_with_checkpoints_of_their_own_lose_nothing(spark, stream, tmp_path):
    folder, store, checkpoint = stream
    write(folder, "1.csv", "M1,2024-05-13T10:00:05Z,65,0.02,99.6,AOK")
    run(store, folder, checkpoint, with_alerts=False)
    other = tmp_path / "other"
    other.mkdir()
    write(other, "1.csv", "M2,2024-05-13T10:00:06Z,65,0.02,99.6,AOK", "M3,2024-05-13T10:00:07Z,65,0.02,99.6,AOK")
    run(store, other, checkpoint + "-2", with_alerts=False)
    assert sorted(r["machine_id"] for r in store.read(B.HISTORY).collect()) == ["M1", "M2", "M3"]
    assert store.read(B.LANDING).count() == 3
    assert sorted(r["machine_id"] for r in store.read(B.MART).collect()) == ["M1", "M2", "M3"]


def test_landed_rows_carry_their_file(spark, stream):
    folder, store, checkpoint = stream
    write(folder, "1.csv", "M1,2024-05-13T10:00:05Z,65,0.02,99.6,AOK")
    jobs.auto_ingest(store, str(folder), checkpoint, trigger={"availableNow": True}).awaitTermination()
    row = store.read(B.LANDING).first()
    assert row["_file_name"] == "1.csv" and row["_loaded_at"] is not None


def test_auto_ingest_reads_each_file_once(spark, stream):
    folder, store, checkpoint = stream
    for n in range(2):
        write(folder, f"{n}.csv", f"M{n},2024-05-13T10:00:05Z,65,0.02,99.6,AOK")
        for _ in range(2):
            jobs.auto_ingest(store, str(folder), checkpoint, trigger={"availableNow": True}).awaitTermination()
        assert summaries.row_count(store.read(B.LANDING)).first()[0] == n + 1


def test_alert_schedule(spark, stream):
    folder, store, checkpoint = stream
    write(folder, "1.csv", "M1,2024-05-13T10:00:10Z,95,0.9,99.6,AOK")
    run(store, folder, checkpoint, with_alerts=False)
    clock = jobs.alert_schedule(store, checkpoint + "-alerts", every="1 second")
    try:
        jobs.await_batch(clock, 120)
    finally:
        clock.stop()
    assert store.read(B.ALERTS).first()["should_send"]


def test_dedup_stream_keeps_what_the_watermark_lets_through(spark, stream):
    folder, store, checkpoint = stream
    key = "65,0.02,99.6,AOK"

    def ingest(name, *lines):
        write(folder, name, *lines)
        jobs.dedup_stream(store, str(folder), checkpoint, "1 hour", trigger={"availableNow": True}).awaitTermination()
        return sorted((r["machine_id"], str(r["event_time"])[11:16]) for r in store.read(B.DEDUPLICATED).collect())

    first = ingest("1.csv", f"M1,2024-05-13T12:00:00Z,{key}", f"M1,2024-05-13T12:00:00Z,{key}", f"M2,2024-05-13T08:00:00Z,{key}", f"M3,,{key}")
    assert first == [("M1", "12:00"), ("M2", "08:00")]  # within a micro-batch nothing is late
    second = ingest(
        "2.csv",
        f"M1,2024-05-13T12:00:00Z,{key}",  # a repetition of an earlier micro-batch
        f"M3,2024-05-13T11:00:01Z,{key}",  # just inside the delay
        f"M4,2024-05-13T11:00:00Z,{key}",  # at the bound: late
        f"M5,2024-05-13T09:00:00Z,{key}",
        f"M6,2024-05-13T13:30:00Z,{key}",
    )
    assert second == sorted([*first, ("M3", "11:00"), ("M6", "13:30")])
    third = ingest("3.csv", f"M1,2024-05-13T12:00:00Z,{key}", f"M3,2024-05-13T12:31:00Z,{key}")
    assert third == sorted([*second, ("M3", "12:31")])
