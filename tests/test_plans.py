"""What the plans must look like to hold at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from millwatch.operators import alerts, history, marts, overview, staging, summaries
from millwatch.plans import queries as Q
from millwatch.session import workspace
from millwatch.sources.tables import Store

SF = "/root/testdata/sf0.001"


def plan(df):
    """The physical plan before it runs."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    return plan(df).split("\n\n")[0]


def above(text, upper, lower):
    """Whether an operator stands before another one in the tree, that is nearer to the result."""
    return text.index(upper) < text.index(lower)


@pytest.fixture(scope="module")
def stored(spark):
    store = Store(spark, workspace(spark))
    rows = Q.readings(spark, SF)
    store.replace("landing", rows)
    store.replace("history", history.first_load(rows))
    store.replace("mart", marts.machine_health(staging.staging_readings(store.read("history"))))
    return store


# The one small table of an alert pass, and the few rows of a sample, may be joined without a key.
KEYLESS = {"sample_rows"}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_cartesian_join_and_no_python(spark, name):
    text = plan(Q.QUERIES[name](spark, SF))
    for unwanted in ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"]:
        assert unwanted not in text or name in KEYLESS


def test_valid_ranges_reach_the_scan_and_only_needed_columns_are_read(stored):
    mart = marts.machine_health(staging.staging_readings(stored.read("history")))
    text = plan(mart)
    assert "GreaterThanOrEqual(temperature,0.0)" in text and "LessThanOrEqual(pressure,500.0)" in text
    assert "_loaded_at" not in text
    assert tree(mart).count("Exchange") == 1
    assert tree(mart).count("HashAggregate") == 2  # one of them before the exchange


def test_bound_is_pushed_and_comes_from_the_newest_day(stored):
    rows = history.increment(stored.read("landing"), stored.before_load("history", "next"))
    text = plan(rows)
    assert re.search(r"PushedFilters: \[IsNotNull\(timestamp\), GreaterThan\(timestamp,ScalarSubquery", text)
    assert re.search(r"PartitionFilters: \[[^]]*event_date#\d+ = Subquery", text) or "event_date" in text
    assert "ReadSchema: struct<event_time:timestamp_ntz>" in text


def test_top_k_of_a_stored_table_begins_at_its_newest_days(spark, stored):
    rows = stored.read("landing", with_folders=True)
    newest = summaries.days_of_recent(rows, 100)
    assert "PartitionFilters: [" in plan(newest) and newest.select("event_date").distinct().count() < 10
    assert newest.count() >= 100


def test_dedup_ranks_before_the_shuffle(stored):
    text = tree(history.dedup_latest(stored.read("history")))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_readings_are_counted_before_they_meet_the_mart(stored):
    df = overview.readings_without_mart(stored.read("landing"), stored.read("mart"))
    text = tree(df)
    join = re.search(r"\w+Join", text).group(0)
    assert above(text, join, "Exchange") or "Broadcast" in join
    assert text.index(join) < text.rindex("HashAggregate")


def test_rolling_metrics_share_their_shuffles(stored):
    from millwatch.operators import trends

    text = tree(trends.rolling_anomalies(stored.read("landing")))
    assert text.count("Exchange") <= 5 and text.count("Window") == 3


def test_top_k_does_not_sort_everything(stored):
    text = tree(summaries.recent_readings(stored.read("landing"), 1000))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_share_reuses_the_grouped_counts(spark, stored):
    df = summaries.distribution(stored.read("landing"), "status_code")
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_parsing_and_reporting_do_not_shuffle(spark):
    messages = spark.range(3).select(F.col("id").alias("message_no"), F.lit("M1|90|x").alias("machines_data"))
    now = F.lit("2024-02-01").cast("timestamp")
    for df in (alerts.parse_payload(messages), alerts.alert_outcome(messages), alerts.render_report(messages, now)):
        assert "Exchange" not in tree(df)
