"""Lenient parsing and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a data file may hold in a numeric cell. A plain cast is wider: it takes `1d` and `0x1p3`.
_NUMBER = r"(?i)^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|[+-]?inf(inity)?)\s*$"


def to_number(text: Column) -> Column:
    """Text as double, NULL when it is no number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_event_time(text: Column) -> Column:
    """ISO-8601 text as a wall-clock timestamp; a zone suffix is dropped, unreadable text is NULL.

    Reading such a column as `timestamp_ntz` straight from CSV yields NULL without a word.
    """
    return text.try_cast("timestamp_ntz")


def null_tokens_to_null(text: Column, tokens: list[str]) -> Column:
    return F.when(~text.isin(tokens), text)


def stringify(value: Column) -> Column:
    """Text for display; NULL shows as `None`."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def fixed(value: Column, digits: int) -> Column:
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value))


def percent(share: Column, digits: int = 1) -> Column:
    return F.concat(fixed(share * 100, digits), F.lit("%"))


def event_time_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def escape_html(text: Column) -> Column:
    for char, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")]:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text
