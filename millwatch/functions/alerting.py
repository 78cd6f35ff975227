"""SQL functions over alert payloads, for SQL users and for the DataFrame operators alike.

A payload is text `machine|risk|issue;machine|risk|issue;…`. The functions are plain SQL expressions: they
are inlined into the query and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from millwatch import settings as S

# Text the alert consumer takes as a number: blanks around it and single underscores between digits
# are fine. A plain cast is both narrower (no underscores) and wider (`1d`).
_DIGITS = r"\d+(?:_\d+)*"
RISK_TEXT = (
    rf"(?i)^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|inf(?:inity)?|nan)\s*$"
)
_RISK = """
    CASE
        WHEN part[1] = '' THEN 0.0D
        WHEN part[1] RLIKE r'(?i)nan' THEN double('NaN')
        ELSE try_cast(replace(part[1], '_', '') AS DOUBLE)
    END
"""

_FUNCTIONS = [
    # Entries with at least three parts; what follows the third is ignored. A blank entry has one.
    """
    CREATE OR REPLACE TEMPORARY FUNCTION payload_parts(payload STRING)
    RETURNS ARRAY<ARRAY<STRING>>
    RETURN filter(
        transform(split(coalesce(payload, ''), ';'), entry -> split(entry, '[|]')),
        part -> size(part) >= 3)
    """,
    # One risk that is no number empties the whole payload.
    f"""
    CREATE OR REPLACE TEMPORARY FUNCTION payload_entries(payload STRING)
    RETURNS ARRAY<STRUCT<machine_id: STRING, risk_score: DOUBLE, issue: STRING>>
    RETURN transform(
        flatten(filter(
            array(payload_parts(payload)),
            parts -> NOT exists(parts, part -> part[1] <> '' AND NOT part[1] RLIKE r'{RISK_TEXT}'))),
        part -> named_struct(
            'machine_id', part[0],
            'risk_score', {_RISK},
            'issue', if(part[2] = '', '{S.DEFAULT_ISSUE}', part[2])))
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION parse_payload(payload STRING)
    RETURNS TABLE(machine_id STRING, risk_score DOUBLE, issue STRING)
    RETURN SELECT inline(entries) FROM (SELECT payload_entries(payload) AS entries)
    """,
    f"""
    CREATE OR REPLACE TEMPORARY FUNCTION alert_outcome(payload STRING)
    RETURNS STRUCT<status: STRING, message: STRING, total_critical_machines: INT, should_send: BOOLEAN>
    RETURN transform(
        array(size(payload_entries(payload))),
        n -> named_struct(
            'status', 'success',
            'message', if(n = 0, '{S.NOTHING_CRITICAL}', NULL),
            'total_critical_machines', n,
            'should_send', n > 0))[0]
    """,
]


def register_functions(spark: SparkSession) -> None:
    """Make `parse_payload`, `alert_outcome` and their helpers known to the session."""
    if not spark.catalog.functionExists("alert_outcome"):
        for statement in _FUNCTIONS:
            spark.sql(statement)
