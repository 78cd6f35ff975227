"""Data-quality checks. Checks on single rows run together in one aggregation per table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwatch import settings as S
from millwatch.functions.readings import any_of, is_urgent
from millwatch.operators import overview, summaries


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when the SQL condition `broken` is TRUE; unknown passes."""

    check: str
    column: str
    broken: str


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def not_null(column: str) -> Rule:
    return Rule("not_null", column, f"`{column}` IS NULL")


def accepted_values(column: str, values: list[str]) -> Rule:
    listed = ", ".join(map(_text, values))
    return Rule("accepted_values", column, f"`{column}` NOT IN ({listed})")


def accepted_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    """Both ends belong to the range; either may be open."""
    sides = [f"`{column}` < {low}"] if low is not None else []
    if high is not None:
        sides.append(f"`{column}` > {high}")
    return Rule("accepted_range", column, " OR ".join(sides))


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that break a rule."""
    return df.filter(rule.broken)


def check_rules(df: DataFrame, model: str, rules: list[Rule], empty_too: bool = False) -> DataFrame:
    """One row per rule with the number of rows that break it: one pass over the table.

    With `empty_too` the same pass also finds out whether there is any row.
    """
    checks = [(r.check, r.column, f"count_if({r.broken})") for r in rules]
    if empty_too:
        checks.append(("table_not_empty", "", "if(count(*) = 0, 1L, 0L)"))
    counts = df.agg(*[F.expr(f"{number} AS v{i}") for i, (_, _, number) in enumerate(checks)])
    results = ", ".join(
        f"struct({_text(model)} AS model, {_text(check)} AS `check`, {_text(column)} AS `column`, "
        f"v{i} AS violations)"
        for i, (check, column, _) in enumerate(checks)
    )
    return counts.selectExpr(f"inline(array({results}))")


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Values, NULL aside, that occur more than once."""
    repeated = summaries.duplicates(df.filter(F.col(column).isNotNull()), [column])
    return _result(repeated.agg(F.count("*").alias("n")), model, "unique", column)


def not_empty(df: DataFrame, model: str) -> DataFrame:
    """One violation when the table has no row. The limit lets Spark stop at the first one."""
    found = df.select(F.lit(1).alias("one")).limit(1).agg(F.count("*").alias("n"))
    return _result(found.select((1 - F.col("n")).alias("n")), model, "table_not_empty", "")


def _result(one_number: DataFrame, model: str, check: str, column: str) -> DataFrame:
    return one_number.select(
        F.lit(model).alias("model"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        F.col("n").cast("bigint").alias("violations"),
    )


def required_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Required names the table lacks, whatever their case."""
    present = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() not in present]


def incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    return df.filter(any_of([F.col(c).isNull() for c in columns]))


def domain_violations(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Distinct values outside the domain; none means the column is a subset of it."""
    return df.filter(~F.col(column).isin(domain)).select(column).distinct()


# --- declared contracts ----------------------------------------------------------------------------
# Which column of which table is bound by which rule.


def landing_rules() -> list[Rule]:
    names = ["machine_id", "timestamp", "temperature", "vibration", "pressure", "status_code"]
    return [*map(not_null, names), accepted_values("status_code", S.STATUS_CODES)]


def staging_rules() -> list[Rule]:
    names = [
        "machine_id", "event_time", "avg_temperature", "max_vibration", "pressure", "reading_status",
        "signal_strength",
    ]
    return [
        *map(not_null, names),
        accepted_range("avg_temperature", -50, 150),
        accepted_range("max_vibration", 0, 100),
        accepted_range("pressure", 0, 500),
        accepted_range("signal_strength", 0, 100),
        accepted_values("reading_status", S.READING_STATUSES),
    ]


def mart_rules() -> list[Rule]:
    names = [
        "machine_id", "last_reading_time", "total_readings", "anomalous_readings", "avg_temperature",
        "max_vibration", "min_signal_strength", "failure_risk_score", "health_status",
        "maintenance_recommendation",
    ]
    return [
        *map(not_null, names),
        accepted_range("total_readings", 0),
        accepted_range("avg_temperature", -50, 150),
        accepted_range("max_vibration", 0, 100),
        accepted_range("min_signal_strength", 0, 100),
        accepted_range("failure_risk_score", 0, 100),
        accepted_values("health_status", S.HEALTH_STATUSES),
        accepted_values("maintenance_recommendation", S.RECOMMENDATIONS),
    ]


MART_REQUIRED = ["machine_id", "health_status", "failure_risk_score", "maintenance_recommendation"]
MACHINES_ALLOWED = (1, 1000)
RECOMMENDATIONS_ALLOWED = (1, 20)
CRITICAL_SHARE_BELOW = 0.5
RISK_BOUNDS = (0, 100)
# ---------------------------------------------------------------------------------------------------


def contract_suite(landing: DataFrame, staging: DataFrame, mart: DataFrame) -> DataFrame:
    """Every declared check on the three tables."""
    return table_checks(landing, staging).unionByName(mart_checks(mart))


def table_checks(landing: DataFrame, staging: DataFrame) -> DataFrame:
    """The declared checks on rows of landing and staging: their counts add up over parts of a table."""
    return check_rules(landing, "landing", landing_rules()).unionByName(
        check_rules(staging, "staging", staging_rules(), empty_too=True)
    )


def mart_checks(mart: DataFrame) -> DataFrame:
    return check_rules(mart, "mart", mart_rules(), empty_too=True).unionByName(unique(mart, "mart", "machine_id"))


def added_up(parts: DataFrame) -> DataFrame:
    """Results for a whole table from those of its parts: broken rows add up, and it is empty if all parts are."""
    total = F.when(F.col("check") == "table_not_empty", F.min("violations")).otherwise(F.sum("violations"))
    return parts.groupBy("model", "check", "column").agg(total.alias("violations"))


def shape_check(readings: DataFrame) -> DataFrame:
    """One row: landing rows of the wrong shape, by kind; NULL never passes."""
    wrong_prefix = ~F.coalesce(F.col("machine_id").startswith("M"), F.lit(False))
    unknown_status = ~F.coalesce(F.col("status_code").isin(S.STATUS_CODES), F.lit(False))
    missing = any_of([F.col(c).isNull() for c in S.SENSORS])
    return readings.agg(
        F.lit(len(readings.columns)).alias("columns"),
        F.count_if(wrong_prefix).alias("wrong_id_prefix"),
        F.count_if(missing).alias("missing_sensor"),
        F.count_if(unknown_status).alias("unknown_status"),
    )


def mart_types(mart: DataFrame) -> bool:
    """Whether the score is a number and the texts are texts."""
    kinds = {f.name.lower(): f.dataType for f in mart.schema}
    texts = ["machine_id", "health_status", "maintenance_recommendation"]
    return isinstance(kinds["failure_risk_score"], T.NumericType) and all(
        isinstance(kinds[c], T.StringType) for c in texts
    )


def required_column_report(df: DataFrame, names: list[str]) -> DataFrame:
    """One row per required name: is there such a column, whatever its case, is its type right, how many rows fill it."""
    lacking = required_columns(df, names)
    typed = not lacking and mart_types(df.select(*names))
    counts = df.agg(*[(F.lit(0) if n in lacking else F.count(n)).cast("bigint").alias(n) for n in names])
    rows = [
        F.struct(F.lit(n).alias("column"), F.lit(n not in lacking).alias("present"), F.lit(typed).alias("types_ok"), F.col(n).alias("filled_rows"))
        for n in names
    ]
    return counts.select(F.inline(F.array(*rows)))


def completeness(mart: DataFrame) -> DataFrame:
    """One row: mart rows with a NULL in a required column."""
    return incomplete(mart, MART_REQUIRED).agg(F.count("*").alias("incomplete_rows"))


def referential(mart: DataFrame, readings: DataFrame) -> DataFrame:
    """Readings without a mart row and mart rows without a reading, as check results."""
    missing = overview.readings_without_mart(readings, mart).toDF("n")
    orphans = overview.mart_without_readings(mart, readings).toDF("n")
    return _result(missing, "landing", "has_mart_row", "machine_id").unionByName(
        _result(orphans, "mart", "has_readings", "machine_id")
    )


def consistency(mart: DataFrame) -> DataFrame:
    """One row: is some CRITICAL text urgent, and is mean risk higher for CRITICAL than for HEALTHY.

    The first holds when nothing is CRITICAL, the second unless all three classes occur.
    """
    status, score = F.col("health_status"), F.col("failure_risk_score")
    critical = status == "CRITICAL"
    urgent = F.bool_or(F.when(critical, is_urgent(F.col("maintenance_recommendation"))))
    means = {s: F.avg(F.when(status == s, score)) for s in S.HEALTH_STATUSES}
    seen = reduce(lambda a, b: a & b, [F.count_if(status == s) > 0 for s in S.HEALTH_STATUSES])
    ordered = F.coalesce(means["CRITICAL"] > means["HEALTHY"], F.lit(False))
    return mart.agg(
        (F.coalesce(urgent, F.lit(False)) | (F.count_if(critical) == 0)).alias("critical_is_urgent"),
        (~seen | ordered).alias("risk_follows_status"),
    )


def no_duplicates(mart: DataFrame) -> DataFrame:
    """Mart rows that occur more than once."""
    return summaries.duplicates(mart, MART_REQUIRED)


def distribution_bounds(mart: DataFrame, machines: tuple[int, int] = MACHINES_ALLOWED) -> DataFrame:
    """One row: are machines, recommendations, the CRITICAL share and all shares within bounds."""
    shares = summaries.distribution(mart, "health_status").agg(
        F.coalesce(
            F.bool_and(F.col("share").between(0, 1)) & (F.abs(F.sum("share") - 1) < 1e-6), F.lit(False)
        ).alias("ok")
    )
    critical = F.count_if(F.col("health_status") == "CRITICAL")
    return mart.agg(
        F.count_distinct("machine_id").alias("machines"),
        F.count_distinct("maintenance_recommendation").alias("recommendations"),
        F.coalesce(F.try_divide(critical, F.count("*")), F.lit(0.0)).alias("critical_share"),
    ).select(
        "machines",
        F.col("machines").between(*machines).alias("machines_ok"),
        "recommendations",
        F.col("recommendations").between(*RECOMMENDATIONS_ALLOWED).alias("recommendations_ok"),
        "critical_share",
        (F.col("critical_share") < CRITICAL_SHARE_BELOW).alias("critical_share_ok"),
        shares.scalar().alias("shares_ok"),
    )


def score_bounds(mart: DataFrame) -> DataFrame:
    """One row: score statistics and whether 0 <= min <= max <= 100 and the mean lies within, too."""
    low, high = RISK_BOUNDS
    ordered = (F.col("min_risk") >= low) & (F.col("min_risk") <= F.col("max_risk")) & (F.col("max_risk") <= high)
    return overview.risk_stats(mart).withColumn(
        "scores_ok", F.coalesce(ordered & F.col("mean_risk").between(low, high), F.lit(False))
    )


def some_positive_corr(mart: DataFrame, readings: DataFrame) -> DataFrame:
    """One row: does any sensor average rise with the health rank."""
    row = overview.status_sensor_correlation(mart, readings)
    any_positive = any_of([F.col(c) > 0 for c in row.columns])
    return row.select(F.coalesce(any_positive, F.lit(False)).alias("some_positive"))


def landing_profile(readings: DataFrame, machines: int = 10) -> DataFrame:
    """The NULL profile, and whether it is what a complete landing table must show."""
    no_nulls = reduce(
        lambda a, b: a & b,
        [F.col(c) == 0 for c in ["null_temperatures", "null_vibrations", "null_status_codes"]],
    )
    timed = F.col("earliest_reading").isNotNull() & F.col("latest_reading").isNotNull()
    return summaries.null_profile(readings).withColumn(
        "profile_ok",
        (F.col("total_records") > 0) & (F.col("unique_machines") == machines) & no_nulls & timed,
    )
