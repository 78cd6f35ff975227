"""The named queries: every operator at work on the given tables.

Each takes a session and a data folder and returns a DataFrame over the whole table. Averages are rounded
for comparison only; the operators themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch import settings as S
from millwatch.functions import readings as R
from millwatch.functions import text as X
from millwatch.functions.alerting import register_functions
from millwatch.operators import alerts, history, kept, overview, quality, staging, summaries, trends
from millwatch.operators.marts import machine_health
from millwatch.plans import build as B
from millwatch.session import workspace
from millwatch.sources import batches, landing, snapshots, testdata
from millwatch.sources.tables import Store, publish_view
from millwatch.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_1_BEFORE = "2024-01-20"  # the first run gets what is earlier ...
RUN_2_FROM = "2024-01-18"  # ... the second what is not earlier than this, so two days come twice
DAMAGED = ["M00001", "M00002"]
DAMAGED_SINCE = "2024-01-20"
REPORT_TIME = "2024-02-01 08:00:00"
WATERMARK_DELAY = "1 day"
PARTS = 4  # of a payload that is given in parts


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- helpers -----------------------------------------------------------------------------------------


def rounded(*columns: str) -> dict[str, Column]:
    """Six digits. Means of short decimals often lie on a rounding tie, which engines break both ways;
    the small shift takes them off it."""
    return {c: F.round(F.col(c) + 1e-9, 6) for c in columns}


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.readings_from_events(spark, sf_dir)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staging_readings(history.rename_cast(readings(spark, sf_dir)))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machine_health(staged(spark, sf_dir))


def runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping runs over hourly readings, in which keys repeat."""
    rows = testdata.hourly_readings(spark, sf_dir)
    return rows.filter(F.col("timestamp") < at(RUN_1_BEFORE)), rows.filter(F.col("timestamp") >= at(RUN_2_FROM))


def store(spark: SparkSession) -> Store:
    return Store(spark, workspace(spark))


def damage(time: str) -> Column:
    return F.col("machine_id").isin(DAMAGED) & (F.col(time) >= at(DAMAGED_SINCE))


def _iso(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _batch_name(time: Column) -> Column:
    """One batch per day."""
    number = F.datediff(F.to_date(time), F.lit("2023-12-31").cast("date"))
    return F.concat(F.lit("sensor_data_batch_"), number.cast("string"), F.lit(".csv"))


def _cells(rows: DataFrame) -> list[Column]:
    sensors = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in S.SENSORS]
    return [F.col("machine_id"), _iso(rows["timestamp"]), *sensors, F.col("status_code")]


@cache
def _faulty_landing(application: str, sf_dir: str, sep: str) -> str:
    """Daily batch folders of all readings with planted faults. Written once per session."""
    spark = SparkSession.active()
    k = F.col("k")
    rows = testdata.readings_with_detail(spark, sf_dir)
    device, time, temperature, vibration, pressure, status = _cells(rows)
    temperature = F.when(k == 14, "null").when(k == 24, "").otherwise(temperature)
    cells = F.concat_ws(
        sep,
        F.when(k == 8, F.concat(device, F.repeat(F.lit("X"), F.lit(50)))).otherwise(device),
        F.when(k == 6, "yesterday").otherwise(time),
        temperature,
        vibration,
        F.when(k == 5, "n/a").otherwise(pressure),
    )
    line = F.when(k == 7, cells).when(k == 17, F.concat_ws(sep, cells, status, F.lit("spare")))
    lines = rows.select(
        _batch_name(F.col("timestamp")).alias("batch"),
        line.otherwise(F.concat_ws(sep, cells, status)).alias("line"),
    )
    path = f"{workspace(spark)}/landing"
    landing.write_landing_batches(lines, path, sep)
    return path


def faulty_landing(spark: SparkSession, sf_dir: str, sep: str = ",") -> str:
    return _faulty_landing(spark.sparkContext.applicationId, sf_dir, sep)


def single_file_landing(spark: SparkSession, sf_dir: str) -> str:
    """Daily batches of one file each, in the order of the events."""
    rows = testdata.readings_with_detail(spark, sf_dir)
    line = F.concat_ws(",", *_cells(rows))
    lines = rows.select("event_id", _batch_name(F.col("timestamp")).alias("batch"), line.alias("line"))
    lines = lines.repartition("batch").sortWithinPartitions("batch", "event_id").select("batch", "line")
    path = f"{workspace(spark)}/landing"
    header = ",".join(f.name for f in schemas.LANDING)
    writer = lines.withColumnRenamed("line", header).write.partitionBy("batch").option("header", True)
    writer.option("sep", "\u0001").option("quote", "").csv(path)
    return path


def write_run(rows: DataFrame, path: str) -> None:
    lines = rows.select(
        _batch_name(F.col("timestamp")).alias("batch"), F.concat_ws(",", *_cells(rows)).alias("line")
    )
    landing.write_landing_batches(lines, path)


# --- sources, sinks, tables ----------------------------------------------------------------------------


@query
def copy_into_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = landing.copy_into(landing.read_landing_csv(spark, faulty_landing(spark, sf_dir)))
    return good


def _reject_cells(bad: DataFrame, sep: str) -> DataFrame:
    """The whole rejected line, cell by cell; numbers as numbers, for text forms of numbers differ between engines."""
    cells = F.split("raw_line", sep)
    names = [*(f.name for f in schemas.LANDING), "spare"]
    texts = {n: F.get(cells, F.lit(i)) for i, n in enumerate(names)}
    columns = [F.size(cells).alias("n_cells")]
    for name, text in texts.items():
        if name in S.SENSORS:
            columns.append(X.to_number(text).alias(name))
            text = F.when(X.to_number(text).isNull(), text)
        columns.append(text.alias(f"{name}_text"))
    return bad.select("reject_reason", *columns)


@query
def copy_into_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = landing.copy_into(landing.read_landing_csv(spark, faulty_landing(spark, sf_dir)))
    return _reject_cells(bad, ",")


@query
def copy_into_rejects_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with another separator: the kept line has it, too."""
    raw = landing.read_landing_csv(spark, faulty_landing(spark, sf_dir, ";"), sep=";")
    return _reject_cells(landing.copy_into(raw, ";")[1], ";")


@query
def copy_into_wrong_separator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the wrong separator nothing loads, and the not-empty check says so."""
    raw = landing.read_landing_csv(spark, faulty_landing(spark, sf_dir), sep=";")
    return quality.not_empty(landing.copy_into(raw)[0], "landing")


@query
def rows_per_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load provenance: rows by the batch their file belongs to."""
    raw = landing.with_provenance(landing.read_landing_csv(spark, faulty_landing(spark, sf_dir)))
    batch = F.regexp_extract(F.col("_metadata.file_path"), S.BATCH_FILE_PATTERN, 0)
    return (
        raw.select(batch.alias("batch"), "_file_name", "_loaded_at")
        .groupBy("batch")
        .agg(
            F.count("*").alias("n"),
            F.count("_loaded_at").alias("with_load_time"),
            F.count_if(F.col("_file_name").endswith(".csv")).alias("with_file_name"),
        )
    )


@query
def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = batches.list_landing_files(spark, faulty_landing(spark, sf_dir))
    return files.select(batches.batch_name().alias("batch")).distinct()


@query
def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.latest_batch(batches.list_landing_files(spark, faulty_landing(spark, sf_dir)))


@query
def batch_resume_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_resume_point(spark, faulty_landing(spark, sf_dir), order="time")


@query
def batch_resume_point_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the last row of the latest batch file."""
    return batches.batch_resume_point(spark, single_file_landing(spark, sf_dir), order="file")


@query
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the cursor that the run before kept."""
    target = store(spark)
    current = batches.list_landing_files(spark, faulty_landing(spark, sf_dir))
    batches.take_new(target, batches.numbered(current).filter(F.col("batch_no") < 20))
    fresh = batches.take_new(target, current)
    again = batches.take_new(target, current).agg(F.count("*").alias("n"))
    return fresh.select(batches.batch_name().alias("batch")).distinct().withColumn("new_after_that", again.scalar())


@query
def new_files_run_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = batches.list_landing_files(spark, faulty_landing(spark, sf_dir))
    processed = batches.numbered(current).filter(F.col("batch_no") < 20)
    fresh = batches.new_files(current, processed).select(batches.batch_name().alias("path")).distinct()
    return batches.run_key(fresh)


def _payload(rows: DataFrame) -> DataFrame:
    return rows.drop("_loaded_at")


@query
def upsert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = runs(spark, sf_dir)
    return _payload(history.upsert(history.first_load(first), history.first_load(second)))


@query
def upsert_stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored table: only days of the second run are rewritten."""
    first, second = runs(spark, sf_dir)
    target = store(spark)
    target.replace(B.HISTORY, history.first_load(first))
    target.upsert(B.HISTORY, history.first_load(second), S.HISTORY_KEY)
    return _payload(target.read(B.HISTORY))


@query
def sync_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier run lacks the pressure and has a column that is gone by the second run; the rows of both."""
    first, second = runs(spark, sf_dir)
    old = _payload(history.first_load(first)).drop("pressure").withColumn("site", F.lit("north"))
    new = _payload(history.first_load(second))
    return history.sync_columns(old, new).unionByName(new)


def _three_loads(spark: SparkSession, sf_dir: str) -> tuple[Store, list[DataFrame]]:
    """An empty store and the history of three parts of the time."""
    rows = _payload(history.first_load(testdata.hourly_readings(spark, sf_dir)))
    day = F.to_date("event_time")
    early, late = F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date")
    return store(spark), [rows.filter(day < early), rows.filter((day >= early) & (day < late)), rows.filter(day >= late)]


@query
def column_readded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that one load drops and the next brings back is NULL in the rows stored before."""
    target, (first, second, third) = _three_loads(spark, sf_dir)
    target.append(B.HISTORY, first.withColumn("site", F.lit("north")), "a")
    target.append(B.HISTORY, second, "b")
    target.append(B.HISTORY, third.withColumn("site", F.lit("south")), "c")
    return target.read(B.HISTORY)


@query
def type_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column comes as a whole number first and as a decimal one later."""
    target, (first, second, third) = _three_loads(spark, sf_dir)
    target.append(B.HISTORY, first.withColumn("pressure", F.floor("pressure")), "a")
    target.append(B.HISTORY, second.unionByName(third), "b")
    return target.read(B.HISTORY)


@query
def schemas_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads with columns of their own, then a delete that looks at columns of all; loads keep the files they wrote until then."""
    target, (first, second, third) = _three_loads(spark, sf_dir)
    target.append(B.HISTORY, first.withColumn("pressure", F.floor("pressure")).withColumn("site", F.lit("north")), "a")
    target.append(B.HISTORY, second, "b")
    target.append(B.HISTORY, third.withColumn("site", F.lit("south")), "c")
    target.delete_where(B.HISTORY, F.col("site").isNull() & (F.col("pressure") > 100))
    return target.read(B.HISTORY)


@query
def table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty landing table takes the place of a filled one and is then filled with the mart's rows."""
    target = store(spark)
    target.replace("replaced", readings(spark, sf_dir))
    target.create("replaced", schemas.MART)
    emptied = target.read("replaced").count()
    target.replace("replaced", mart(spark, sf_dir).select(schemas.MART.names))
    rows = target.read("replaced").withColumns(rounded("avg_temperature"))
    return rows.withColumn("records_when_emptied", F.lit(emptied).cast("bigint"))


# --- projections, filters, predicates ------------------------------------------------------------------


@query
def staging_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)


@query
def invalid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.rename_cast(readings(spark, sf_dir))
    rows = staging.staging_readings(rows, include_invalid=True)
    return summaries.equals(rows, "reading_status", "invalid")


@query
def signal_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(
        "machine_id",
        "timestamp",
        "status_code",
        R.signal_strength(F.col("status_code")).alias("signal_strength"),
    )


@query
def anomalous_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).filter("is_anomalous")


@query
def machines_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summaries.machines_since(readings(spark, sf_dir), DAMAGED, at(DAMAGED_SINCE))
    return summaries.label(rows, "backup")


@query
def incomplete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.incomplete(readings(spark, sf_dir), S.SENSORS)


@query
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = store(spark)
    target.replace(B.HISTORY, history.rename_cast(readings(spark, sf_dir)))
    target.delete_where(B.HISTORY, damage("event_time"), since=DAMAGED_SINCE)
    return target.read(B.HISTORY)


@query
def classify_reading_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.classification_drift(readings(spark, sf_dir))


@query
def gauge_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.gauge_bands(readings(spark, sf_dir))


@query
def risk_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.risk_labels(mart(spark, sf_dir))


@query
def risk_by_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.risk_by_machine(mart(spark, sf_dir))


@query
def readings_of_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.equals(readings(spark, sf_dir), "machine_id", DAMAGED[0])


@query
def staging_view_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging view as a SQL user reads it."""
    publish_view(staged(spark, sf_dir), B.STAGING_VIEW)
    return spark.sql(f"""
        SELECT reading_status, count(*) AS n, min(event_time) AS first_time, max(event_time) AS last_time
        FROM {B.STAGING_VIEW} GROUP BY reading_status""")


# --- joins -----------------------------------------------------------------------------------------------


@query
def high_water_mark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = runs(spark, sf_dir)
    bound = history.high_water_mark(history.rename_cast(first))
    return history.after_high_water_mark(history.rename_cast(second), bound)


def _second_source(rows: DataFrame, letter: str, broken: bool) -> DataFrame:
    """The same readings as those of other machines, all of them invalid if so wanted."""
    renamed = rows.withColumn("machine_id", F.concat(F.lit(letter), "machine_id"))
    return renamed.withColumn("temperature", F.lit(-1.0)) if broken else renamed


@query
def readings_without_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a second source whose readings are all invalid, so its machines have no mart row."""
    rows = readings(spark, sf_dir)
    both = rows.unionByName(_second_source(rows, "X", broken=True))
    both_mart = machine_health(staging.staging_readings(history.rename_cast(both)))
    return overview.readings_without_mart(both, both_mart)


@query
def mart_without_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a second source in the mart that the landing table has lost."""
    rows = readings(spark, sf_dir)
    both = rows.unionByName(_second_source(rows, "S", broken=False))
    both_mart = machine_health(staging.staging_readings(history.rename_cast(both)))
    return overview.mart_without_readings(both_mart, rows)


@query
def mart_vs_sensor_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = overview.mart_vs_sensor_averages(mart(spark, sf_dir), readings(spark, sf_dir))
    return both.withColumns(rounded("avg_temp", "avg_vibration", "avg_pressure"))


# --- aggregations ----------------------------------------------------------------------------------------


@query
def machine_health_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir).withColumns(rounded("avg_temperature"))


@query
def machine_health_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored runs, then the mart over the whole history."""
    target = store(spark)
    for batch, rows in enumerate(runs(spark, sf_dir)):
        B.build(target, rows, f"batch-{batch}")
    B.rebuild(target)
    return target.read(B.MART).withColumns(rounded("avg_temperature"))


@query
def machine_health_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mart kept up to date by adding the totals of each run."""
    target = store(spark)
    for batch, rows in enumerate(runs(spark, sf_dir)):
        B.build(target, rows, f"batch-{batch}")
    return target.read(B.MART).withColumns(rounded("avg_temperature"))


@query
def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = summaries.table_summary(readings(spark, sf_dir), "final state")
    return summary.withColumns(rounded("avg_temperature"))


@query
def machines_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.label(
        summaries.machines_record_count(readings(spark, sf_dir), DAMAGED), "backup"
    )


@query
def per_machine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.per_machine_summary(readings(spark, sf_dir)).withColumns(rounded("avg_temp"))


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.null_profile(readings(spark, sf_dir))


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.duplicates(testdata.hourly_readings(spark, sf_dir), ["machine_id", "timestamp"])


@query
def duplicate_keys_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the kept table after two loads, the second run twice; a key may have a row in either load."""
    rows = testdata.hourly_readings(spark, sf_dir)
    target, half = store(spark), F.pmod(F.xxhash64("temperature", "status_code"), F.lit(2))
    for k in (0, 1, 1):
        B.keep_keys(target, rows.filter(half == k), f"load-{k}")
    return B.duplicate_keys(target)


@query
def unique_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uniqueness check of the landing keys from the kept counts of two loads."""
    rows = testdata.hourly_readings(spark, sf_dir)
    target, half = store(spark), F.pmod(F.xxhash64("temperature", "status_code"), F.lit(2))
    for k in (0, 1):
        B.keep_keys(target, rows.filter(half == k), f"load-{k}")
    return B.uniqueness(target)


@query
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.distribution(mart(spark, sf_dir), "health_status").withColumns(rounded("share"))


@query
def reading_status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summaries.distribution(readings(spark, sf_dir), "status_code")
    return rows.withColumns(rounded("share"))


@query
def risk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.risk_stats(mart(spark, sf_dir)).withColumns(rounded("mean_risk"))


@query
def mean_risk_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.mean_by(mart(spark, sf_dir), "health_status", "failure_risk_score", "mean_risk")


@query
def critical_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.critical_payload(mart(spark, sf_dir))


@query
def critical_payload_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.critical_payload(mart(spark, sf_dir), PARTS)


@query
def critical_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The critical machines, one row each: what a message is made of."""
    return alerts.critical_entries(mart(spark, sf_dir))


@query
def status_sensor_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = overview.status_sensor_correlation(mart(spark, sf_dir), readings(spark, sf_dir))
    return row.withColumns(rounded(*row.columns))


def _kept_figures(spark: SparkSession, sf_dir: str) -> Store:
    """A store with the figures of two loads, the second of them run twice."""
    target, rows = store(spark), history.rename_cast(readings(spark, sf_dir))
    early = F.coalesce(F.col("event_time") < at(RUN_1_BEFORE), F.lit(False))
    B.keep_figures(target, rows.filter(early), "load-1")
    for _ in range(2):
        B.keep_figures(target, rows.filter(~early), "load-2")
    return target


@query
def status_correlation_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As status_sensor_correlation, from stored totals of two loads."""
    row = overview.status_average_correlation(mart(spark, sf_dir), B.sensor_averages(_kept_figures(spark, sf_dir)))
    return row.withColumns(rounded(*row.columns))


@query
def machines_per_day_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per day from stored figures of two loads, and whether the sketched number of machines is within its error of the exact one beside it."""
    days = kept.merge_machine_days(_kept_figures(spark, sf_dir).read(B.MACHINE_DAYS))
    rows = history.rename_cast(readings(spark, sf_dir))
    exact = rows.groupBy(F.to_date("event_time").alias("day")).agg(F.count_distinct("machine_id").alias("n_machines"))
    near = kept.within_error(F.hll_sketch_estimate("machines"), F.col("n_machines")).alias("within_error")
    return days.join(exact, days["day"].eqNullSafe(exact["day"])).select(days["day"].cast("string").alias("day"), "n_readings", "n_machines", near)


@query
def machines_of_all_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the same over all days, from the union of the stored sketches."""
    exact = readings(spark, sf_dir).agg(F.count_distinct("machine_id").alias("exact"))
    both = B.machines_between(_kept_figures(spark, sf_dir)).withColumn("exact", exact.scalar())
    near = kept.within_error(F.col("n_machines"), F.col("exact")).alias("within_error")
    return both.select("n_readings", F.col("exact").alias("n_machines"), near)


@query
def factory_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = overview.factory_overview(mart(spark, sf_dir))
    return row.withColumns(rounded("healthy_percent", "critical_percent", "avg_risk_score"))


@query
def distinct_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.distinct_machines(mart(spark, sf_dir))


@query
def machines_with_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.any_anomaly(trends.rolling_anomalies(readings(spark, sf_dir)))


# --- windows ---------------------------------------------------------------------------------------------


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.dedup_latest(history.rename_cast(testdata.hourly_readings(spark, sf_dir)))


def _rolling(spark: SparkSession, sf_dir: str, metrics: list[str], order: str) -> DataFrame:
    rows = trends.rolling_anomalies(readings(spark, sf_dir), metrics, order=order)
    return rows.withColumns(rounded(*[f"{m}_{part}" for m in metrics for part in ("mean", "std")]))


@query
def rolling_anomalies_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir, ["temperature"], "desc")


@query
def rolling_anomalies_vibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir, ["vibration"], "desc")


@query
def rolling_anomalies_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir, ["pressure"], "desc")


@query
def rolling_anomalies_causal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir, S.SENSORS, "asc")


@query
def current_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.current_readings(readings(spark, sf_dir))


@query
def latest_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.current_readings(readings(spark, sf_dir), "latest")


def _rounded_deltas(rows: DataFrame) -> DataFrame:
    return rows.withColumns(rounded(*[f"{c}_{part}" for c in S.SENSORS for part in ("mean", "delta")]))


@query
def current_reading_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_deltas(trends.reading_deltas(readings(spark, sf_dir)))


@query
def dashboard_reading_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the dashboard's recent readings, a top-k report."""
    recent = summaries.recent_readings(readings(spark, sf_dir), S.RECENT_ROWS)
    return _rounded_deltas(trends.reading_deltas(recent))


@query
def dashboard_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = summaries.recent_readings(readings(spark, sf_dir), S.RECENT_ROWS)
    return trends.mean_recent(recent).withColumns(rounded(*[f"{c}_mean" for c in S.SENSORS]))


# --- sorts and limits --------------------------------------------------------------------------------------


@query
def recent_readings_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summaries.recent_readings(readings(spark, sf_dir), S.RECENT_ROWS)
    return rows.withColumns({c: X.stringify(F.col(c)) for c in ["machine_id", "status_code"]})


@query
def recent_readings_for_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.recent_for(readings(spark, sf_dir), DAMAGED, 10)


@query
def recent_stored_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recent readings of a stored landing table, from its newest days only."""
    target = store(spark)
    target.replace(B.LANDING, readings(spark, sf_dir))
    newest = summaries.days_of_recent(target.read(B.LANDING, with_folders=True), S.RECENT_ROWS)
    return summaries.recent_readings(newest, S.RECENT_ROWS).select(schemas.LANDING.names)


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a free sample has, and how many of them are readings."""
    rows = readings(spark, sf_dir)
    return summaries.sampled_from(summaries.sample(rows, 5), rows)


# --- set operations, scalars ---------------------------------------------------------------------------------


@query
def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_violations(readings(spark, sf_dir), "status_code", S.STATUS_CODES)


@query
def scalar_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mart(spark, sf_dir).withColumns(rounded("avg_temperature"))
    risk = X.fixed(F.col("failure_risk_score").cast("double"), 2)
    return rows.select(
        "machine_id",
        risk.alias("risk_text"),
        X.to_number(risk).alias("risk_number"),
        X.to_number(F.col("health_status")).alias("status_number"),
        X.fixed(F.col("avg_temperature") + 1e-7, 1).alias("temperature_text"),
        X.percent(F.col("failure_risk_score") / 100).alias("risk_percent"),
        X.event_time_text(F.col("last_reading_time")).alias("seen_text"),
        X.to_event_time(X.event_time_text(F.col("last_reading_time"))).alias("seen_time"),
        X.stringify(F.col("health_status")).alias("status_text"),
        R.status_rank(F.col("health_status")).alias("status_rank"),
    )


# --- streaming -------------------------------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, alerts_too: bool = False, parts: int = 1) -> Store:
    """Both runs as files, each taken up by one micro-batch of the same stream."""
    folder = workspace(spark)
    target = Store(spark, f"{folder}/store")
    for rows in runs(spark, sf_dir):
        write_run(rows, f"{folder}/landing")
        jobs.stream_build(
            target,
            f"{folder}/landing",
            f"{folder}/checkpoint",
            trigger={"availableNow": True},
            with_alerts=alerts_too,
            now=F.lit(REPORT_TIME).cast("timestamp"),
            alert_parts=parts,
        ).awaitTermination()
    return target


@query
def stream_incremental_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload(_streamed(spark, sf_dir).read(B.HISTORY))


@query
def dedup_stream_watermarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of both runs, each taken up by one micro-batch, that came no later than a day behind what was there."""
    folder = workspace(spark)
    target = Store(spark, f"{folder}/store")
    for rows in runs(spark, sf_dir):
        write_run(rows, f"{folder}/landing")
        jobs.dedup_stream(target, f"{folder}/landing", f"{folder}/checkpoint", WATERMARK_DELAY, trigger={"availableNow": True}).awaitTermination()
    return target.read(B.DEDUPLICATED).select("machine_id", "event_time")


@query
def stream_machine_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).read(B.MART).withColumns(rounded("avg_temperature"))


@query
def stream_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results on the whole tables, added up from those of the micro-batches."""
    return B.check_results(_streamed(spark, sf_dir))


def _alert_rows(target: Store) -> DataFrame:
    return target.read(B.ALERTS).select(
        "batch", "message_no", "machines_data", "status", "message", "total_critical_machines", "should_send"
    )


@query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(_streamed(spark, sf_dir, True))


@query
def stream_alerts_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(_streamed(spark, sf_dir, True, PARTS))


@query
def stream_second_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream with a checkpoint and files of its own on the same store: nothing of either is lost."""
    folder = workspace(spark)
    target = Store(spark, f"{folder}/store")
    for n, rows in enumerate(runs(spark, sf_dir)):
        write_run(rows, f"{folder}/landing-{n}")
        jobs.stream_build(
            target, f"{folder}/landing-{n}", f"{folder}/checkpoint-{n}", trigger={"availableNow": True}
        ).awaitTermination()
    return _payload(target.read(B.HISTORY))


@query
def ingest_then_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that another job has landed still reach the history of the build; rows per table."""
    folder = workspace(spark)
    target = Store(spark, f"{folder}/store")
    write_run(readings(spark, sf_dir), f"{folder}/landing")
    for n, job in enumerate((jobs.auto_ingest, jobs.stream_build)):
        job(target, f"{folder}/landing", f"{folder}/checkpoint-{n}", trigger={"availableNow": True}).awaitTermination()
    return _payload(target.read(B.HISTORY))


@query
def stream_on_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream on its polling interval: it takes up files that come while it runs."""
    folder = workspace(spark)
    target = Store(spark, f"{folder}/store")
    first, second = runs(spark, sf_dir)
    write_run(first, f"{folder}/landing")
    stream = jobs.stream_build(target, f"{folder}/landing", f"{folder}/checkpoint")
    try:
        stream.processAllAvailable()
        write_run(second, f"{folder}/landing")
        stream.processAllAvailable()
    finally:
        stream.stop()
    return _payload(target.read(B.HISTORY))


@query
def scheduled_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the alert schedule stores at a tick."""
    target = store(spark)
    target.replace(B.MART, mart(spark, sf_dir))
    now = F.lit(REPORT_TIME).cast("timestamp")
    clock = jobs.alert_schedule(target, f"{workspace(spark)}/checkpoint", "1 second", now, PARTS)
    try:
        jobs.await_batch(clock)
    finally:
        clock.stop()
    return _alert_rows(target).drop("batch").distinct()


@query
def stream_landing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic ingest of the faulty files: typed rows with their provenance."""
    target = store(spark)
    jobs.auto_ingest(
        target,
        faulty_landing(spark, sf_dir),
        f"{workspace(spark)}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    rejected = target.read(B.REJECTS).agg(F.count("*"))
    return target.read(B.LANDING).select(
        *schemas.LANDING.names,
        F.col("_file_name").endswith(".csv").alias("has_file"),
        F.col("_loaded_at").isNotNull().alias("has_load_time"),
        rejected.scalar().alias("rejected"),
    )


# --- alert functions ---------------------------------------------------------------------------------------------


def _payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload text per event: two entries, some of them faulty."""
    k = F.col("k")
    rows = testdata.read_events(spark, sf_dir)
    rows = rows.withColumn("k", testdata.detail_number(rows))
    device = testdata.machine_id(F.col("user_id"))
    first = F.concat(device, F.lit("|"), k.cast("string"), F.lit("|"), F.col("event_type"))
    second = (
        F.when(k % 10 == 1, F.concat(device, F.lit("||")))
        .when(k % 10 == 2, F.concat(device, F.lit("|zz|late")))
        .when(k % 10 == 3, F.concat(device, F.lit("|7")))
        .when(k % 10 == 4, F.concat(device, F.lit("| 1_0.5 |worn|spare")))
        .when(k % 10 == 5, " ")
        .otherwise(F.concat(device, F.lit("|60|slow")))
    )
    text = F.when(k % 10 == 0, F.lit("  ")).otherwise(F.concat_ws(";", first, second))
    return rows.select("event_id", text.alias("machines_data"))


@query
def parse_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.parse_payload(_payload_texts(spark, sf_dir))


@query
def alert_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_outcome(_payload_texts(spark, sf_dir)).drop("machines_data")


@query
def alert_outcome_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = alerts.critical_payload(mart(spark, sf_dir), PARTS)
    return alerts.alert_outcome(messages, together=True).drop("machines_data")


@query
def alert_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = alerts.critical_payload(mart(spark, sf_dir))
    return alerts.render_report(messages, F.lit(REPORT_TIME).cast("timestamp")).drop("machines_data")


@query
def alert_report_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = alerts.critical_payload(mart(spark, sf_dir), PARTS)
    now = F.lit(REPORT_TIME).cast("timestamp")
    return alerts.render_report(messages, now, together=True).drop("machines_data")


@query
def scheduled_alert_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the schedule runs each time: the alert function over the view of critical machines."""
    register_functions(spark)
    publish_view(alerts.critical_payload(mart(spark, sf_dir)), "critical_machines_list")
    return spark.sql("""
        SELECT message_no, outcome.*
        FROM (SELECT message_no, alert_outcome(coalesce(machines_data, '')) AS outcome
              FROM critical_machines_list)""")


# --- snapshots -----------------------------------------------------------------------------------------------------


def _damaged(spark: SparkSession, sf_dir: str) -> tuple[Store, list[str | None]]:
    """A store whose landing table has lost rows, with a backup of the days concerned; and those days."""
    target = store(spark)
    target.replace(B.LANDING, readings(spark, sf_dir))
    rows = target.read(B.LANDING, with_folders=True)
    days = target.days(rows.filter(F.col("event_date") >= F.lit(DAMAGED_SINCE).cast("date")).filter(damage("timestamp")))
    snapshots.back_up(target, B.LANDING, "landing_backup", days)
    target.delete_where(B.LANDING, damage("timestamp"), since=DAMAGED_SINCE)
    return target, days


@query
def recovery_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, days = _damaged(spark, sf_dir)
    stages = {"before damage": readings(spark, sf_dir)}
    damaged = target.read(B.LANDING)
    target.replace("as_damaged", damaged)
    snapshots.restore(target, B.LANDING, "landing_backup", days)
    stages |= {"after damage": target.read("as_damaged"), "final state": target.read(B.LANDING)}
    return summaries.checkpoint_report(stages).withColumns(rounded("avg_temperature"))


@query
def restored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole landing table after damage and recovery."""
    target, days = _damaged(spark, sf_dir)
    snapshots.restore(target, B.LANDING, "landing_backup", days)
    return target.read(B.LANDING)


@query
def recovery_missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, days = _damaged(spark, sf_dir)
    return snapshots.missing_rows(target, B.LANDING, "landing_backup", days)


@query
def recovery_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the damage left of the affected machines."""
    target, _ = _damaged(spark, sf_dir)
    rows = target.read(B.LANDING).filter(F.col("machine_id").isin(DAMAGED))
    return summaries.per_machine_summary(rows).withColumns(rounded("avg_temp"))


# --- data quality ----------------------------------------------------------------------------------------------------


def _checked(spark: SparkSession, sf_dir: str, check: str) -> DataFrame:
    tables = {
        "landing": (readings(spark, sf_dir), quality.landing_rules()),
        "staging": (staged(spark, sf_dir), quality.staging_rules()),
        "mart": (mart(spark, sf_dir), quality.mart_rules()),
    }
    parts = []
    for model, (df, rules) in tables.items():
        chosen = [r for r in rules if r.check == check]
        if chosen:
            parts.append(quality.check_rules(df, model, chosen))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, "not_null")


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_mart = quality.unique(mart(spark, sf_dir), "mart", "machine_id")
    return on_mart.unionByName(quality.unique(readings(spark, sf_dir), "landing", "machine_id"))


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, "accepted_values")


@query
def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, "accepted_range")


@query
def dq_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings a range check names."""
    rule = quality.accepted_range("temperature", *S.VALID_RANGE["temperature"])
    return quality.violations(readings(spark, sf_dir), rule)


@query
def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = staged(spark, sf_dir).filter(F.col("avg_temperature") > 150)
    return quality.not_empty(staged(spark, sf_dir), "staging").unionByName(quality.not_empty(hot, "hot"))


@query
def dq_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.shape_check(readings(spark, sf_dir))


@query
def dq_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns of the mart, asked for in capitals, and one that does not exist."""
    names = [c.upper() for c in quality.MART_REQUIRED]
    return quality.required_column_report(mart(spark, sf_dir), [*names, "NO_SUCH_COLUMN"])


@query
def dq_mart_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.required_column_report(mart(spark, sf_dir), quality.MART_REQUIRED)


@query
def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(mart(spark, sf_dir))


@query
def dq_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.referential(mart(spark, sf_dir), readings(spark, sf_dir))


@query
def dq_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.consistency(mart(spark, sf_dir))


@query
def dq_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the critical machines of the mart in it twice."""
    rows = mart(spark, sf_dir)
    return quality.no_duplicates(rows.unionByName(rows.filter(F.col("health_status") == "CRITICAL")))


@query
def dq_distribution_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distribution_bounds(mart(spark, sf_dir)).withColumns(rounded("critical_share"))


@query
def dq_score_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_bounds(mart(spark, sf_dir)).withColumns(rounded("mean_risk"))


@query
def dq_some_positive_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.some_positive_corr(mart(spark, sf_dir), readings(spark, sf_dir))


@query
def dq_landing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.landing_profile(readings(spark, sf_dir))


@query
def dq_suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contract_suite(readings(spark, sf_dir), staged(spark, sf_dir), mart(spark, sf_dir))


@query
def run_batch_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the declared checks on the whole tables after the second of two stored runs."""
    target = store(spark)
    first, second = runs(spark, sf_dir)
    B.run_batch(target, first, "batch-0")
    return B.run_batch(target, second, "batch-1")


# The flagship goes by the name of its result.
QUERIES["machine_health"] = QUERIES.pop("machine_health_mart")
