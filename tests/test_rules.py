"""Edges of the rules for single readings and machines."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millwatch.functions import readings as R
from millwatch.functions import text as X
from millwatch.operators import marts, overview, staging

HISTORY = (
    "machine_id string, event_time timestamp_ntz, temperature double, vibration double, "
    "pressure double, status_code string"
)
T0 = datetime(2024, 5, 13, 10)
NAN = float("nan")


def history(spark, *readings):
    rows = [(f"M{i:03d}", T0, *r) for i, r in enumerate(readings)]
    return spark.createDataFrame(rows, HISTORY)


def evaluate(spark, column, values, kind="double"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in rows.select("i", column(F.col("x"))).orderBy("i").collect()]


def test_ranges_are_closed_and_nothing_else_is_a_reading(spark):
    kept = [(0.0, 0.0, 0.0, "AOK"), (150.0, 2.0, 500.0, "AOK")]
    dropped = [
        (150.01, 1.0, 100.0, "AOK"),
        (-0.01, 1.0, 100.0, "AOK"),
        (NAN, 1.0, 100.0, "AOK"),
        (None, 1.0, 100.0, "AOK"),
        (50.0, 2.01, 100.0, "AOK"),
        (50.0, 1.0, 500.1, "AOK"),
    ]
    df = history(spark, *kept, *dropped)
    assert staging.staging_readings(df).count() == 2
    everything = staging.staging_readings(df, include_invalid=True)
    assert everything.filter("reading_status = 'invalid'").count() == len(dropped)
    assert everything.filter("avg_temperature IS NULL").count() == 4


@pytest.mark.parametrize(
    ("reading", "anomalous"),
    [
        ((100.0, 0.1, 100.0, "AOK"), False),
        ((100.1, 0.1, 100.0, "AOK"), True),
        ((50.0, 1.0, 100.0, "AOK"), False),
        ((50.0, 1.01, 100.0, "AOK"), True),
        ((50.0, 0.1, 450.0, "AOK"), False),
        ((50.0, 0.1, 450.1, "AOK"), True),
        ((50.0, 0.1, 100.0, "CRIT"), True),
        ((50.0, 0.1, 100.0, None), False),
    ],
)
def test_anomaly_edges(spark, reading, anomalous):
    row = staging.staging_readings(history(spark, reading)).first()
    assert row["is_anomalous"] is anomalous
    assert row["reading_status"] == ("anomalous" if anomalous else "normal")


def test_threshold_is_a_parameter(spark):
    df = history(spark, (80.0, 0.1, 100.0, "AOK"))
    assert staging.staging_readings(df, threshold=70).first()["is_anomalous"]


def test_signal_strength_is_case_sensitive(spark):
    codes = ["AOK", "WARN", "CRIT", "aok", "FAULT", None]
    assert evaluate(spark, R.signal_strength, codes, "string") == [100, 60, 20, 0, 0, 0]


def test_tier_edges(spark):
    by_temperature = evaluate(
        spark, lambda x: R.risk_tier(x, F.lit(0.0))["failure_risk_score"], [75.0, 75.1, 90.0, 90.1, None]
    )
    by_vibration = evaluate(
        spark, lambda x: R.risk_tier(F.lit(0.0), x)["failure_risk_score"], [0.6, 0.61, 0.8, 0.81, None]
    )
    assert by_temperature == by_vibration == [30, 60, 60, 90, 30]


def test_labels_and_ranks(spark):
    statuses = ["HEALTHY", "NEEDS_MAINTENANCE", "CRITICAL", "odd", None]
    assert evaluate(spark, R.risk_label, statuses, "string") == [
        "Low Risk", "Medium Risk", "High Risk", "High Risk", "High Risk",
    ]
    assert evaluate(spark, R.status_rank, statuses, "string") == [0, 1, 2, None, None]


def test_gauge_bands_are_half_open_with_a_closed_end(spark):
    values = [-1.0, 0.0, 49.9, 50.0, 75.0, 100.0, 100.1, None]
    assert evaluate(spark, lambda x: R.gauge_band(x, "temperature"), values) == [
        None, 1, 1, 2, 3, 3, None, None,
    ]


def test_classification(spark):
    by_pressure = evaluate(
        spark,
        lambda x: R.classify_reading(F.lit(70.0), F.lit(0.1), x),
        [92.0, 92.1, 95.0, 95.1, 104.9, 105.0, 110.0],
    )
    assert by_pressure == ["CRIT", "WARN", "WARN", "AOK", "AOK", "WARN", "CRIT"]


def test_numbers_in_text(spark):
    texts = ["1.5", " 2 ", ".5", "5.", "1e3", "nan", "-inf", "1d", "0x1p3", "zz", "", None]
    got = evaluate(spark, X.to_number, texts, "string")
    assert got[5] != got[5]
    assert got[:5] + got[6:] == [1.5, 2.0, 0.5, 5.0, 1000.0, float("-inf"), None, None, None, None, None]


def test_event_time_drops_the_zone(spark):
    texts = ["2024-05-13T10:00:04Z", "2024-05-13T10:00:04+02:00", "yesterday", None]
    assert evaluate(spark, X.to_event_time, texts, "string") == [
        datetime(2024, 5, 13, 10, 0, 4), datetime(2024, 5, 13, 10, 0, 4), None, None,
    ]


def test_display_texts(spark):
    assert evaluate(spark, lambda x: X.fixed(x, 2), [90.0, None]) == ["90.00", None]
    assert evaluate(spark, X.percent, [0.125, None]) == ["12.5%", None]
    assert evaluate(spark, X.stringify, ["a", None], "string") == ["a", "None"]
    assert evaluate(spark, X.escape_html, ["<b a='1'>&\""], "string") == ["&lt;b a=&#39;1&#39;&gt;&amp;&quot;"]


def test_machine_with_only_invalid_readings_is_not_in_the_mart(spark):
    df = history(spark, (50.0, 0.1, 100.0, "AOK"), (-1.0, 0.1, 100.0, "AOK"))
    mart = marts.machine_health(staging.staging_readings(df))
    assert [r["machine_id"] for r in mart.collect()] == ["M000"]
    landing = df.withColumnRenamed("event_time", "timestamp")
    assert overview.readings_without_mart(landing, mart).first()[0] == 1
    assert overview.mart_without_readings(mart, landing).first()[0] == 0


def test_a_reading_without_machine_counts_as_missing_in_the_mart(spark):
    df = spark.createDataFrame([(None, T0, 50.0, 0.1, 100.0, "AOK")], HISTORY)
    mart = marts.machine_health(staging.staging_readings(df))
    assert mart.count() == 1
    landing = df.withColumnRenamed("event_time", "timestamp")
    assert overview.readings_without_mart(landing, mart).first()[0] == 1


def test_empty_input(spark):
    mart = marts.machine_health(staging.staging_readings(history(spark).limit(0)))
    assert mart.isEmpty()
    row = overview.factory_overview(mart).first()
    assert (row["total_machines"], row["healthy_percent"], row["avg_risk_score"]) == (0, None, None)


def test_merged_totals_equal_totals_of_all(spark):
    rows = [
        (f"M{i % 5}", T0.replace(minute=i), 60.0 + i, 0.01 * i, 100.0, "CRIT" if i % 7 == 0 else "AOK")
        for i in range(40)
    ]
    staged = staging.staging_readings(spark.createDataFrame(rows, HISTORY))
    early = F.col("event_time") < T0.replace(minute=13)
    merged = marts.merge_totals(
        marts.machine_totals(staged.filter(early)), marts.machine_totals(staged.filter(~early))
    )
    assert sorted(marts.assess(merged).collect()) == sorted(marts.machine_health(staged).collect())


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (1.0, 3.0, 2.0), (1.0, None, 9.0), (1.0, 7.0, 4.0)], "c double, x double, y double")
    row = df.agg(
        overview.correlation(F.col("c"), F.col("y")).alias("constant"),
        overview.correlation(F.col("x"), F.col("y")).alias("varying"),
        F.corr("x", "y").alias("expected"),
    ).first()
    assert row["constant"] is None
    assert row["varying"] == pytest.approx(row["expected"])
