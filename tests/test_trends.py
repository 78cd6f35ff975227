"""Rolling windows against pandas, and windows in blocks against plain ones."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from pyspark.sql import functions as F

from millwatch.operators import trends

SCHEMA = "machine_id string, timestamp timestamp_ntz, temperature double, vibration double, pressure double"
T0 = datetime(2024, 1, 1)


def by_pandas(rows, metric, window, descending):
    out = {}
    frame = pd.DataFrame(rows, columns=["machine_id", "timestamp", "temperature", "vibration", "pressure"])
    for machine, part in frame.groupby("machine_id"):
        part = part.sort_values("timestamp", ascending=not descending)
        mean = part[metric].rolling(window).mean()
        std = part[metric].rolling(window).std()
        flag = (part[metric] - mean).abs() > 2 * std + 1e-9
        for t, m, s, f in zip(part["timestamp"], mean, std, flag, strict=True):
            out[machine, t.to_pydatetime()] = (m, s, bool(f))
    return out


@pytest.mark.parametrize("order", ["desc", "asc"])
@pytest.mark.parametrize("block_rows", [10**9, 30])
def test_rolling_equals_pandas(spark, order, block_rows):
    r = random.Random(7)
    rows = []
    for machine, n in [("M1", 150), ("M2", 19), ("M3", 20), ("M4", 60)]:
        for i in range(n):
            value = None if machine == "M4" and i == 30 else 70 + r.gauss(0, 1) + (15 if i % 37 == 36 else 0)
            rows.append((machine, T0 + timedelta(seconds=i * i), value, 0.5, 100.0))
    df = spark.createDataFrame(rows, SCHEMA)
    got = trends.rolling_anomalies(df, ["temperature", "vibration"], order=order, block_rows=block_rows).collect()
    want = by_pandas(rows, "temperature", 20, order == "desc")
    assert len(got) == len(rows)
    for row in got:
        mean, std, flag = want[row["machine_id"], row["timestamp"]]
        assert row["temperature_anomaly"] == flag
        if pd.isna(mean):
            assert row["temperature_mean"] is None and row["temperature_std"] is None
        else:
            assert row["temperature_mean"] == pytest.approx(mean)
            assert row["temperature_std"] == pytest.approx(std)
        assert row["vibration_anomaly"] is False  # equal values never flag
    assert any(r["temperature_anomaly"] for r in got)
    assert not any(r["temperature_anomaly"] for r in got if r["machine_id"] == "M2")


def test_without_sigmas_nothing_flags(spark):
    rows = [("M1", T0 + timedelta(seconds=i), float(i == 25), 0.5, 100.0) for i in range(40)]
    flagged = trends.rolling_anomalies(spark.createDataFrame(rows, SCHEMA), ["temperature"], sigmas=None)
    assert flagged.filter("temperature_anomaly").isEmpty()


def hot_rows_of_every_kind(seed):
    """One machine with bursts, many rows at one time, exact copies and rows without a time."""
    r = random.Random(seed)

    def value():
        x = r.random()
        special = None if x < 0.05 else float("nan") if x < 0.07 else float("inf")
        return special if x < 0.08 else round(r.uniform(0, 100), 1)

    def values():
        return value(), value(), value()

    rows = [("hot", T0 + timedelta(seconds=r.random() ** 4 * 1e6), *values()) for _ in range(300)]
    rows += [("hot", T0 + timedelta(seconds=500), *values()) for _ in range(100)]
    rows += [("hot", T0 + timedelta(seconds=900), 5.0, 6.0, 7.0) for _ in range(150)]
    rows += [("hot", None, *values()) for _ in range(80)]
    rows += [(None, T0 + timedelta(seconds=r.randint(0, 50)), *values()) for _ in range(60)]
    rows += [("same", T0, 1.0, None, float("nan")) for _ in range(200)]
    for m in range(8):
        rows += [(f"M{m}", T0 + timedelta(seconds=r.randint(0, 999)), *values()) for _ in range(r.randint(1, 30))]
    r.shuffle(rows)
    return rows


def bag(df):
    return sorted(
        tuple(repr(round(v, 9)) if isinstance(v, float) else repr(v) for v in row) for row in df.collect()
    )


@pytest.mark.parametrize("order", ["desc", "asc"])
@pytest.mark.parametrize("block_rows", [100, 7])
def test_blocks_change_nothing(spark, order, block_rows):
    df = spark.createDataFrame(hot_rows_of_every_kind(3), SCHEMA)
    whole = trends.rolling_anomalies(df, rows=7, order=order)
    blocks = trends.rolling_anomalies(df, rows=7, order=order, block_rows=block_rows)
    assert bag(blocks) == bag(whole)
    assert blocks.count() == df.count()


def test_building_a_window_starts_no_job(spark):
    df = spark.createDataFrame(hot_rows_of_every_kind(5), SCHEMA)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("windows", "building only")
    trends.rolling_anomalies(df, rows=7)
    jobs = tracker.getJobIdsForGroup("windows")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_nan_is_no_value(spark):
    rows = [("M1", T0 + timedelta(seconds=i), float("nan") if i == 5 else float(i % 3), 0.5, 1.0) for i in range(40)]
    flagged = trends.rolling_anomalies(spark.createDataFrame(rows, SCHEMA), ["temperature"], rows=10, order="asc")
    assert flagged.filter(F.isnan("temperature_mean") | F.isnan("temperature_std")).isEmpty()
    by_time = {r["timestamp"]: r["temperature_mean"] for r in flagged.collect()}
    assert by_time[T0 + timedelta(seconds=14)] is None and by_time[T0 + timedelta(seconds=15)] is not None


def test_readings_at_one_time_have_an_order(spark):
    rows = [("M1", T0, t, 0.1, 100.0) for t in (65.0, 60.0, 70.0)] + [("M1", None, 1.0, 0.1, 100.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert trends.current_readings(df).first()["temperature"] == 60.0
    assert trends.current_readings(df, "latest").first()["temperature"] == 70.0


def test_current_reading_and_deltas(spark):
    rows = [("M1", T0 + timedelta(hours=i), 60.0 + 10 * i, 0.1, 100.0 + i) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert trends.current_readings(df).first()["temperature"] == 60.0
    assert trends.current_readings(df, "latest").first()["temperature"] == 80.0
    row = trends.reading_deltas(df).first()
    assert row["temperature_delta"] == pytest.approx(-10.0)
    assert row["temperature_far"] and not row["pressure_far"] and not row["vibration_far"]
    assert trends.mean_recent(df).first()["temperature_mean"] == pytest.approx(70.0)
