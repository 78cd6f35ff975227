"""Data-quality checks on rows that break them."""

from datetime import datetime

import pytest

from millwatch import schemas
from millwatch.operators import quality

MART = "machine_id string, failure_risk_score int, health_status string, maintenance_recommendation string"
NOW, URGENT, LATER, NONE = datetime(2024, 5, 13), "Immediate maintenance required", "Schedule maintenance within 48 hours", "No action needed"


def mart(spark, *rows):
    return spark.createDataFrame(rows, MART)


def results(df):
    return {(r["check"], r["column"]): r["violations"] for r in df.collect()}


def test_rules_count_breaking_rows_and_let_unknown_pass(spark):
    df = spark.createDataFrame([(None, "a"), (-1.0, "z"), (5.0, None), (10.1, "a")], "x double, s string")
    rules = [
        quality.not_null("x"),
        quality.accepted_range("x", 0, 10),
        quality.accepted_range("x", low=0),
        quality.accepted_values("s", ["a", "b"]),
    ]
    got = [r["violations"] for r in quality.check_rules(df, "t", rules).collect()]
    assert got == [1, 2, 1, 1]
    assert quality.violations(df, rules[3]).count() == 1


def test_unique_names_repeated_values_once(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert quality.unique(df, "t", "x").first()["violations"] == 1


def test_not_empty(spark):
    df = spark.range(1)
    assert quality.not_empty(df, "t").first()["violations"] == 0
    assert quality.not_empty(df.limit(0), "t").first()["violations"] == 1


def test_suite_notices_empty_tables(spark):
    none = spark.createDataFrame([], schemas.STAGING)
    suite = quality.contract_suite(
        spark.createDataFrame([], schemas.LANDING), none, spark.createDataFrame([], schemas.MART)
    )
    broken = suite.filter("violations > 0").collect()
    assert sorted((r["model"], r["check"], r["violations"]) for r in broken) == [
        ("mart", "table_not_empty", 1), ("staging", "table_not_empty", 1),
    ]


def test_required_columns_ignore_case(spark):
    df = spark.createDataFrame([(1, 2)], "MACHINE_ID int, Health_Status int")
    assert quality.required_columns(df, quality.MART_REQUIRED) == ["failure_risk_score", "maintenance_recommendation"]


def test_types(spark):
    assert quality.mart_types(mart(spark, ("M1", 30, "HEALTHY", NONE)))
    assert not quality.mart_types(spark.createDataFrame([("M1", "30", "HEALTHY", NONE)], MART.replace("int", "string")))


def test_completeness_and_duplicates(spark):
    df = mart(spark, ("M1", 30, "HEALTHY", None), ("M2", 30, "HEALTHY", NONE), ("M2", 30, "HEALTHY", NONE))
    assert quality.completeness(df).first()[0] == 1
    assert quality.no_duplicates(df).first()["occurrences"] == 2


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([("M1", 90, "CRITICAL", URGENT), ("M2", 60, "NEEDS_MAINTENANCE", LATER), ("M3", 30, "HEALTHY", NONE)], (True, True)),
        ([("M1", 20, "CRITICAL", URGENT), ("M2", 60, "NEEDS_MAINTENANCE", LATER), ("M3", 30, "HEALTHY", NONE)], (True, False)),
        ([("M1", 20, "CRITICAL", "wait"), ("M3", 30, "HEALTHY", NONE)], (False, True)),
        ([("M1", 90, "CRITICAL", "URGENT stop"), ("M2", 90, "CRITICAL", None)], (True, True)),
        ([("M3", 30, "HEALTHY", NONE)], (True, True)),
    ],
)
def test_consistency(spark, rows, expected):
    assert tuple(quality.consistency(mart(spark, *rows)).first()) == expected


def test_distribution_bounds(spark):
    row = quality.distribution_bounds(mart(spark, ("M1", 90, "CRITICAL", URGENT), ("M2", 30, "HEALTHY", NONE))).first()
    assert row["machines_ok"] and row["recommendations_ok"] and row["shares_ok"]
    assert row["critical_share"] == 0.5 and not row["critical_share_ok"]
    empty = quality.distribution_bounds(mart(spark, ("M1", 30, "HEALTHY", NONE)).limit(0)).first()
    assert not empty["machines_ok"] and not empty["shares_ok"]


def test_score_bounds(spark):
    assert quality.score_bounds(mart(spark, ("M1", 90, "CRITICAL", URGENT))).first()["scores_ok"]
    assert not quality.score_bounds(mart(spark, ("M1", 101, "CRITICAL", URGENT))).first()["scores_ok"]


def test_domain_and_shape(spark):
    df = spark.createDataFrame(
        [("M1", NOW, 1.0, 1.0, 1.0, "AOK"), ("X1", NOW, None, 1.0, 1.0, "odd"), (None, NOW, 1.0, 1.0, 1.0, None)],
        "machine_id string, timestamp timestamp_ntz, temperature double, vibration double, pressure double, status_code string",
    )
    assert [r[0] for r in quality.domain_violations(df, "status_code", ["AOK"]).collect()] == ["odd"]
    assert tuple(quality.shape_check(df).first()) == (6, 2, 1, 2)
    assert quality.landing_profile(df, machines=2).first()["profile_ok"] is False
    assert quality.incomplete(df, ["temperature"]).count() == 1


def test_correlation_check_needs_varying_classes(spark):
    one_class = mart(spark, ("M1", 30, "HEALTHY", NONE), ("M2", 30, "HEALTHY", NONE))
    readings = spark.createDataFrame(
        [("M1", 1.0, 1.0, 1.0), ("M2", 2.0, 1.0, 1.0)], "machine_id string, temperature double, vibration double, pressure double"
    )
    assert quality.some_positive_corr(one_class, readings).first()[0] is False
    two = mart(spark, ("M1", 30, "HEALTHY", NONE), ("M2", 90, "CRITICAL", URGENT))
    assert quality.some_positive_corr(two, readings).first()[0] is True
