"""Payload text, its parsing, outcome and report."""

import random

import pytest
from pyspark.sql import functions as F

from millwatch.functions.alerting import register_functions
from millwatch.operators import alerts

MART = "machine_id string, failure_risk_score int, health_status string, maintenance_recommendation string"
CASES = {
    None: [],
    "": [],
    " ": [],
    "M1|90": [],
    "M1||": [("M1", 0.0, "Immediate maintenance required")],
    "M1|90|a|b": [("M1", 90.0, "a")],
    "M1|90|x;M2|zz|y": [],
    "M1|90|x; ;M2|8|y": [("M1", 90.0, "x"), ("M2", 8.0, "y")],
    "M1| 1_0.5 |x;;M2|1e3|y": [("M1", 10.5, "x"), ("M2", 1000.0, "y")],
    "M1| |x": [],
    "M1|1d|x": [],
    "M1|1__0|x": [],
    "M1|-inf|x": [("M1", float("-inf"), "x")],
}


def messages(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "message_no int, machines_data string")


@pytest.mark.parametrize("text", list(CASES))
def test_parse(spark, text):
    rows = alerts.parse_payload(messages(spark, text)).orderBy("position").collect()
    assert [(r["machine_id"], r["risk_score"], r["issue"]) for r in rows] == CASES[text]


def accepted(risk):
    """What Python makes of a risk text; None where it is no number."""
    try:
        return float(risk)
    except ValueError:
        return None


def test_risks_are_what_python_takes_for_numbers(spark):
    r = random.Random(11)
    marks = list("0123456789") + ["_", ".", "e", "E", "+", "-", " ", "d", "f", "x", "inf", "nan", "Infinity"]
    risks = ["".join(r.choices(marks, k=r.randint(1, 6))) for _ in range(3000)]
    risks += ["1", "1_0", "1__0", "_1", "1_", "1.", ".5", ".", "1._5", "1_.5", "1e5", "1e+5_0", "e5", "+-1", "1e400", " 7\t"]
    rows = alerts.parse_payload(messages(spark, *[f"M{i}|{risk}|worn" for i, risk in enumerate(risks)])).collect()
    got = {r["message_no"]: (r["machine_id"], repr(r["risk_score"]), r["issue"]) for r in rows}
    known = {i: (f"M{i}", repr(accepted(risk)), "worn") for i, risk in enumerate(risks) if accepted(risk) is not None}
    assert got == known and 300 < len(got) < 2500


def test_sql_table_function(spark):
    register_functions(spark)
    rows = spark.sql("SELECT * FROM parse_payload('M1|90|x;M2||y')").collect()
    assert [tuple(r) for r in rows] == [("M1", 90.0, "x"), ("M2", 0.0, "y")]


def test_outcome(spark):
    rows = alerts.alert_outcome(messages(spark, "M1|90|x;M2|8|y", "", "M1|zz|x")).orderBy("message_no").collect()
    assert [(r["status"], r["message"], r["total_critical_machines"], r["should_send"]) for r in rows] == [
        ("success", None, 2, True),
        ("success", "No critical machines found", 0, False),
        ("success", "No critical machines found", 0, False),
    ]


def test_payload_of_nothing_is_one_empty_message(spark):
    mart = spark.createDataFrame([("M1", 30, "HEALTHY", "No action needed")], MART)
    assert [tuple(r) for r in alerts.critical_payload(mart).collect()] == [(0, "")]


def test_payload_entries(spark):
    mart = spark.createDataFrame(
        [("M2", 90, "CRITICAL", None), ("M1", 90, "CRITICAL", "Stop"), (None, 90, "CRITICAL", "lost"), ("M3", 60, "NEEDS_MAINTENANCE", "x")],
        MART,
    )
    assert alerts.critical_payload(mart).first()["machines_data"] == "M1|90|Stop;M2|90|Immediate maintenance required"


def critical(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("machine_id"),
        F.lit(90).alias("failure_risk_score"),
        F.lit("CRITICAL").alias("health_status"),
        F.lit("Stop").alias("maintenance_recommendation"),
    )


@pytest.mark.parametrize("parts", [1, 8])
def test_the_layout_of_a_payload_does_not_depend_on_its_size(spark, parts):
    mart = critical(spark, 10_001)
    payload = alerts.critical_payload(mart, parts)
    assert [r["message_no"] for r in payload.orderBy("message_no").collect()] == list(range(parts))
    parsed = alerts.parse_payload(payload)
    assert parsed.select("machine_id").distinct().count() == parsed.count() == 10_001
    sent = alerts.alert_messages(mart, F.lit("2024-02-01 08:00:00").cast("timestamp"), parts).collect()
    assert {r["subject"] for r in sent} == {"CRITICAL ALERT: 10001 Machines Require Immediate Attention"}
    assert {r["total_critical_machines"] for r in sent} == {10_001}
    assert alerts.critical_entries(mart).count() == 10_001


def test_parts_without_machines(spark):
    sent = alerts.alert_messages(critical(spark, 1), F.lit("2024-02-01").cast("timestamp"), 3).collect()
    assert sorted((r["should_send"], r["subject"] is not None, r["total_critical_machines"]) for r in sent) == [
        (False, False, 1), (False, False, 1), (True, True, 1),
    ]
    none = alerts.alert_messages(critical(spark, 0), F.lit("2024-02-01").cast("timestamp"), 3).collect()
    assert {(r["message"], r["should_send"], r["total_critical_machines"]) for r in none} == {
        ("No critical machines found", False, 0)
    }


def test_report(spark):
    now = F.lit("2024-02-01 08:00:00").cast("timestamp")
    full, empty = alerts.render_report(messages(spark, "M<1|90|a & b;M2|8.5|y", ""), now).orderBy("message_no").collect()
    assert full["subject"] == "CRITICAL ALERT: 2 Machines Require Immediate Attention"
    assert "- Machine ID: M<1\n  Risk Score: 90.0%\n  Issue: a & b\n" in full["body_text"]
    assert "Report Generated: 2024-02-01 08:00:00" in full["body_text"]
    assert "CRITICAL MACHINES:\n\n- Machine ID: M<1\n" in full["body_text"]
    assert "<td>M&lt;1</td><td>90.0%</td><td>a &amp; b</td>" in full["body_html"]
    assert (empty["subject"], empty["body_text"], empty["body_html"]) == (None, None, None)
