"""Alert payloads, their parsing, and the report for critical machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millwatch import settings as S
from millwatch.functions.alerting import register_functions
from millwatch.functions.text import escape_html, event_time_text

def _all_parts() -> WindowSpec:
    """Over all messages of an alert pass, a fixed few."""
    return Window.partitionBy(F.lit(0))



def critical_entries(mart: DataFrame) -> DataFrame:
    """`machine|score|text` per CRITICAL machine; an unknown machine or score has a NULL entry."""
    text = F.coalesce("maintenance_recommendation", F.lit(S.DEFAULT_ISSUE))
    entry = F.concat(
        "machine_id", F.lit("|"), F.col("failure_risk_score").cast("string"), F.lit("|"), text
    )
    return mart.filter(F.col("health_status") == "CRITICAL").select("machine_id", entry.alias("entry"))


def critical_payload(mart: DataFrame, parts: int = 1) -> DataFrame:
    """The payload text of all CRITICAL machines, in machine order: `(message_no, machines_data)`.

    One text by default, empty when there is no machine. With `parts` a machine's md5 picks its part; there
    are always so many messages, whatever the number of machines. `critical_entries` is the form
    without any text that grows with the machines.
    """
    number = F.pmod(F.conv(F.substring(F.md5("machine_id"), 1, 8), 16, 10).cast("bigint"), F.lit(parts)).cast("int")
    entries = critical_entries(mart).filter(F.col("entry").isNotNull())
    # Blank entries, which the text join skips, make every message exist.
    blank = mart.sparkSession.range(parts).select(
        F.col("id").cast("int").alias("message_no"), *[F.lit(None).cast("string").alias(c) for c in entries.columns]
    )
    text = F.expr("listagg(entry, ';') WITHIN GROUP (ORDER BY machine_id)")
    return (
        entries.select(number.alias("message_no"), "machine_id", "entry")
        .unionByName(blank)
        .groupBy("message_no")
        .agg(F.coalesce(text, F.lit("")).alias("machines_data"))
    )


def _entries(payload: str) -> Column:
    return F.call_function("payload_entries", F.col(payload))


def parse_payload(messages: DataFrame, payload: str = "machines_data") -> DataFrame:
    """One row per machine of each message, in payload order, beside the message's other columns."""
    register_functions(messages.sparkSession)
    others = [c for c in messages.columns if c != payload]
    # An inner explode would parse twice: Spark first filters on the size of what it explodes.
    return (
        messages.select(*others, _entries(payload).alias("entries"))
        .select(*others, F.posexplode_outer("entries").alias("position", "entry"))
        .filter(F.col("position").isNotNull())
        .select(*others, "position", "entry.*")
    )


def alert_outcome(messages: DataFrame, payload: str = "machines_data", together: bool = False) -> DataFrame:
    """The messages with the status, message, machine count and sending decision of each.

    `together`: the messages are the parts of one payload, and the count is that of all of them.
    """
    register_functions(messages.sparkSession)
    outcome = F.call_function("alert_outcome", F.col(payload))
    if not together:
        return messages.withColumn("outcome", outcome).select(*messages.columns, "outcome.*")
    total = F.sum("outcome.total_critical_machines").over(_all_parts()).cast("int")
    return messages.withColumn("outcome", outcome).withColumn("total", total).select(
        *messages.columns,
        "outcome.status",
        F.when(F.col("total") == 0, F.lit(S.NOTHING_CRITICAL)).alias("message"),
        F.col("total").alias("total_critical_machines"),
        "outcome.should_send",
    )


def render_report(
    messages: DataFrame, now: Column, payload: str = "machines_data", together: bool = False
) -> DataFrame:
    """The messages with subject, text body and HTML body, NULL where a message names no machine.

    Every message is rendered where it lies. `together`: the messages are the parts of one payload, and
    subject and bodies give the number of machines in all of them.
    """
    register_functions(messages.sparkSession)
    entries = F.col("entries")
    named, when = F.size(entries), event_time_text(now)
    count = F.col("total")

    def risk(e: Column) -> Column:
        return e["risk_score"].cast("string")

    lines = F.transform(
        entries, lambda e: F.format_string(S.REPORT_ENTRY, e["machine_id"], risk(e), e["issue"])
    )
    text = F.concat_ws(
        "\n",
        F.lit(S.REPORT_TITLE),
        F.lit(""),
        F.concat(F.lit(S.REPORT_TOTAL), count.cast("string")),
        F.concat(F.lit(S.REPORT_TIME), when),
        F.lit(""),
        F.lit(S.REPORT_LIST),
        F.lit(""),
        F.array_join(lines, "\n"),
        F.lit(S.REPORT_CALL),
    )
    cells = F.transform(
        entries,
        lambda e: F.concat(
            F.lit("<tr><td>"),
            F.concat_ws(
                "</td><td>",
                escape_html(e["machine_id"]),
                F.concat(risk(e), F.lit("%")),
                escape_html(e["issue"]),
            ),
            F.lit("</td></tr>"),
        ),
    )
    headings = "".join(f"<th>{h}</th>" for h in S.REPORT_ENTRY_HEADINGS)
    html = F.concat(
        F.lit(f"<html><body><h2>{S.REPORT_TITLE}</h2><p>{S.REPORT_TOTAL}"),
        count.cast("string"),
        F.lit(f"<br>{S.REPORT_TIME}"),
        when,
        F.lit(f"</p><table><tr>{headings}</tr>"),
        F.array_join(cells, ""),
        F.lit(f"</table><p>{S.REPORT_CALL}</p></body></html>"),
    )
    parts = {
        "subject": F.format_string(S.REPORT_SUBJECT, count),
        "body_text": text,
        "body_html": html,
    }
    return (
        messages.withColumn("entries", _entries(payload))
        .withColumn("total", F.sum(named).over(_all_parts()).cast("int") if together else named)
        .withColumns({name: F.when(named > 0, part) for name, part in parts.items()})
        .drop("entries", "total")
    )


def alert_messages(mart: DataFrame, now: Column, parts: int = 1) -> DataFrame:
    """Payload, outcome and report of one alert pass: what the scheduled call returns and sends."""
    outcomes = alert_outcome(critical_payload(mart, parts), together=True)
    return render_report(outcomes, now, together=True).withColumn("reported_at", now)
