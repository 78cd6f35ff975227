"""Stored tables: plain Parquet folders, partitioned by day and load.

    <root>/<table>/<generation>/event_date=<day>/load_id=<load>/*.parquet     (<generation>-<shape> from the second shape on)
    <root>/schemas/<table>/<number>-<generation>-<shape>      an empty Parquet file with the columns: what the table is now
    <root>/redo/<table>, <root>/aside/<table>/...     a change of days that is under way

The day is that of a row's time; a table without times has one folder for the missing day. A load is one run of
a job: a micro-batch of a stream (the stream's own id and the batch number) or a named batch. Writing a load
overwrites the folders of that load only (Spark's dynamic partition overwrite), so a load that is run again
after a failure does not add its rows twice, and loads of different streams never meet.

Replacing a table writes a new generation and then names it in a new schema entry, which is the moment of the change. Readers
take the newest finished entry; GENERATIONS earlier ones stay, so a DataFrame planned before ends with the rows it was
planned on.

A change of columns stores nothing anew. A new column becomes NULL in files without it. A column that goes or changes its type
begins a new shape: a folder of its own for what is written from then on, while the files of earlier shapes stay as they
are. A read takes each shape with its own columns and carries it through all later schema entries (casts, NULLs, columns left out), so a
column that goes and comes back is NULL in the rows before. Filters on the folders reach every shape. After SHAPES
shapes the next change rewrites the table as a new generation with one.

Upserts and deletes rewrite the days they touch: the new content is written aside, a record of the days and of that folder
is written, the days' folders are removed and written anew in one job, and the record is removed. While the record is there,
readers take those days from aside. A write that dies leaves it behind, and the next change of the table, or repair(), first
brings it to its end. So days are never lost: before the record is finished the table is as it was, after it as it should be.
A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwatch.session import children, finished, remove

DAY, LOAD = "event_date", "load_id"
WHOLE = "whole"  # load of rows that no single run wrote
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_TIMES = ("event_time", "timestamp")
GENERATIONS = 4  # kept besides the newest one
SHAPES = 16  # read together at most
_WIDER = ("tinyint", "smallint", "int", "bigint", "float", "double")  # a cast to the right keeps every value from becoming NULL
_RECORD = "generation int, days array<string>, content string"


class Store:
    """The tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}  # by the path of their entry, which never changes

    def path(self, name: str) -> str:
        """The folder that is written to: the newest shape of the newest generation."""
        _, generation, number = self._entry(name)
        return self._shape_path(name, generation, number)

    def _shape_path(self, name: str, generation: int, number: int) -> str:
        return f"{self.root}/{name}/{generation:08d}" + (f"-{number:04d}" if number > 1 else "")

    def _entries(self, name: str) -> list[str]:
        return [e for e in children(self.spark, f"{self.root}/schemas/{name}") if not e.startswith(("_", "."))]

    def _entry(self, name: str) -> tuple[str | None, int, int]:
        """The newest finished schema entry, its generation and shape; (None, 1, 1) if there is none."""
        for entry in reversed(self._entries(name)):
            if finished(self.spark, f"{self.root}/schemas/{name}/{entry}"):
                return entry, *_numbers(entry)
        return None, 1, 1

    def _columns(self, name: str, entry: str) -> T.StructType:
        path = f"{self.root}/schemas/{name}/{entry}"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self._schemas[path]

    def _steps(self, name: str) -> list[tuple[int, T.StructType]]:
        """Shape and columns of every finished entry of the newest generation, in order."""
        newest, generation, _ = self._entry(name)
        entries = [e for e in self._entries(name) if _numbers(e)[0] == generation and e <= (newest or "")]
        done = [e for e in entries if e == newest or finished(self.spark, f"{self.root}/schemas/{name}/{e}")]
        return [(_numbers(e)[1], self._columns(name, e)) for e in done]

    # --- reading -------------------------------------------------------------------------------

    def schema(self, name: str) -> T.StructType | None:
        """The columns of a table, without those of its folders; None if there is no such table."""
        entry = self._entry(name)[0]
        return None if entry is None else self._columns(name, entry)

    def exists(self, name: str) -> bool:
        return self.schema(name) is not None

    def read(self, name: str, with_folders: bool = False) -> DataFrame:
        """The rows of a table; `with_folders` adds event_date and load_id, for pruning."""
        schema = self.schema(name)
        if schema is None:
            raise LookupError(f"no table {name}")
        rows = self._rows(name)
        return rows if with_folders else rows.select(schema.names)

    def _rows(self, name: str) -> DataFrame:
        steps = self._steps(name)
        rows = self._of_shapes(name, steps, {number for number, _ in steps})
        change = self._change(name)
        if change is None:
            return rows
        touched = self._match(change["days"])
        return rows.filter(~touched).unionByName(self._files(change["content"], with_folders(steps[-1][1])))

    def _of_shapes(self, name: str, steps: list[tuple[int, T.StructType]], shapes: set[int]) -> DataFrame:
        """The rows of these shapes, each read with its own last columns and carried through the entries after it."""
        generation = self._entry(name)[1]
        parts = []
        for number in sorted(shapes):
            last = max(i for i, (of, _) in enumerate(steps) if of == number)
            rows = self._files(self._shape_path(name, generation, number), with_folders(steps[last][1]))
            for (_, before), (_, after) in zip(steps[last:], steps[last + 1 :], strict=False):
                rows = carried(rows, before, after)
            parts.append(rows)
        return reduce(DataFrame.unionByName, parts)

    def _files(self, path: str, columns: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(columns).parquet(path).select(columns.names)
        except AnalysisException:  # a folder that never got a row
            return self.spark.createDataFrame([], columns)

    def load(self, name: str, load: str) -> DataFrame:
        """The rows one load wrote."""
        return self.read(name, with_folders=True).filter(F.col(LOAD) == load).drop(DAY, LOAD)

    def before_load(self, name: str, load: str) -> DataFrame:
        """The newest day of what a table had before a load: the latest time is there."""
        rows = self.read(name, with_folders=True).filter(F.col(LOAD) != load)
        newest = rows.agg(F.max(DAY).alias(DAY))
        return rows.filter(F.col(DAY) == newest.scalar()).drop(DAY, LOAD)

    # --- whole tables --------------------------------------------------------------------------

    def create(self, name: str, schema: T.StructType) -> None:
        """An empty table; earlier content is gone."""
        self.replace(name, self.spark.createDataFrame([], schema))

    def replace(self, name: str, df: DataFrame, load: str = WHOLE) -> None:
        """Rebuild a table from a DataFrame, which may read this table. Readers see the old rows until the new ones are all there."""
        self._whole(name, placed(df, load), df.schema)

    def _whole(self, name: str, rows: DataFrame, schema: T.StructType) -> None:
        entry, newest, _ = self._entry(name)
        generation = newest + 1 if entry else 1
        self._write(rows, self._shape_path(name, generation, 1), "static")  # what an unfinished attempt left goes
        self._set_schema(name, schema, generation, 1)

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        _balanced(rows).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(DAY, LOAD).parquet(path)

    def _set_schema(self, name: str, schema: T.StructType, generation: int, number: int) -> None:
        """A new entry: from now on the table has these columns. Entries and generations long past go."""
        entries = self._entries(name)
        place = int(entries[-1].split("-")[0]) + 1 if entries else 1
        path = f"{self.root}/schemas/{name}/{place:08d}-{generation:08d}-{number:04d}"
        self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)
        for old in entries:
            if _numbers(old)[0] < generation - GENERATIONS:
                remove(self.spark, f"{self.root}/schemas/{name}/{old}")
        for old in children(self.spark, f"{self.root}/{name}"):
            if old[:8].isdigit() and int(old[:8]) < generation - GENERATIONS:
                remove(self.spark, f"{self.root}/{name}/{old}")

    # --- loads ---------------------------------------------------------------------------------

    def append(self, name: str, df: DataFrame, load: str) -> None:
        """Add the rows of a load, or put them in place of those that this load wrote before.

        New columns become part of the table and are NULL in older rows; columns gone from `df` leave it; a changed type is
        cast. Stored files stay as they are; a cast that would lose a value fails before anything is changed.
        """
        before = self.schema(name)
        if before is None:
            return self._whole(name, placed(df, load), df.schema)  # the schema last: a table exists when it has its rows
        self.repair(name)
        if shape(before) != shape(df.schema):
            self._evolve(name, before, df.schema)
        steps = self._steps(name)
        older = {number for number, _ in steps} - {steps[-1][0]}
        if older and not self._of_shapes(name, steps, older).filter(F.col(LOAD) == load).isEmpty():
            return self._move_load(name, df, load)
        self._write(placed(df, load), self.path(name), "dynamic")

    def _move_load(self, name: str, df: DataFrame, load: str) -> None:
        """A load that lies in an earlier shape is run again with other columns: its days are changed, as an upsert does."""
        incoming = self._from_aside(name, placed(df, load))
        rows = self.read(name, with_folders=True)
        days = self.days(rows.filter(F.col(LOAD) == load).select(DAY).union(incoming.select(DAY)))
        rest = self.of_days(rows, days).filter(F.col(LOAD) != load)
        self._put_days(name, self._aside(name, rest.unionByName(incoming)), days)

    def _evolve(self, name: str, before: T.StructType, after: T.StructType) -> None:
        """The table has other columns from now on: in the same shape if some were only added, else in a new one."""
        kinds = {f.name: f.dataType for f in before}
        kept = [f for f in after if f.name in kinds]
        changed = [f for f in kept if kinds[f.name] != f.dataType]
        _, generation, number = self._entry(name)
        if len(kept) == len(before) and not changed:
            return self._set_schema(name, after, generation, number)
        self._check_casts(name, [f for f in changed if not _widens(kinds[f.name], f.dataType)])
        if number < SHAPES:
            self._set_schema(name, after, generation, number + 1)
        else:
            self._whole(name, carried(self._rows(name), before, after), after)

    def _check_casts(self, name: str, fields: list[T.StructField]) -> None:
        """Fail if a stored value has none in its new type: Spark does so in ANSI mode, the count does in the other. Reads these columns only."""
        if not fields:
            return
        lost = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).cast(f.dataType).isNull()).alias(f.name) for f in fields]
        counts = self._rows(name).agg(*lost).first()
        bad = [f"{f.name} as {f.dataType.simpleString()}: {counts[f.name]}" for f in fields if counts[f.name]]
        if bad:
            raise ValueError(f"stored values of {name} that cannot be cast: {', '.join(bad)}")

    def _aside(self, name: str, df: DataFrame) -> str:
        """Written to a folder of its own, by day and load."""
        path = f"{self.root}/aside/{name}/{uuid.uuid4().hex}"
        self._write(df, path, "static")
        return path

    def _from_aside(self, name: str, df: DataFrame) -> DataFrame:
        return self._files(self._aside(name, df), with_folders(df.drop(DAY, LOAD).schema))

    def kept(self, df: DataFrame) -> DataFrame:
        """The rows as they are now, whatever becomes of the tables they come from."""
        return self._from_aside("kept", placed(df, WHOLE)).select(df.columns)

    # --- changing days -------------------------------------------------------------------------

    def days(self, rows: DataFrame) -> list[str | None]:
        """The days of some rows: at most one value per day of history."""
        return sorted((r["day"] for r in rows.select(F.col(DAY).cast("string").alias("day")).distinct().collect()), key=str)

    def upsert(self, name: str, df: DataFrame, keys: list[str]) -> None:
        """Rows of `df` take the place of rows with the same key; all others are added.

        `df` must hold a key once. The key of a dated table must have its time, so equal keys share a day and
        only days present in `df` are read and rewritten. A NULL in a key matches nothing.
        """
        schema = self.schema(name)
        if schema is None:
            return self.append(name, df, WHOLE)
        self.repair(name)
        if shape(schema) != shape(df.schema):
            self._evolve(name, schema, df.schema)
        time = time_column(df.schema)
        if time and time not in keys:
            raise ValueError(f"the key of a dated table must have {time}")
        incoming = self._from_aside(name, placed(df, WHOLE))
        days = self.days(incoming)
        rest = self.of_days(self.read(name, with_folders=True), days).join(incoming.select(*keys), keys, "left_anti")
        self._put_days(name, self._aside(name, rest.unionByName(incoming)), days)

    def delete_where(self, name: str, condition: Column, since: str | None = None) -> None:
        """Remove the rows for which the condition is TRUE; rows where it is unknown stay.

        `since`, a day before which the condition is never TRUE, keeps earlier days from being read.
        """
        self.repair(name)
        rows = self.read(name, with_folders=True)
        scope = rows if since is None else rows.filter(F.col(DAY) >= F.lit(since).cast("date"))
        days = self.days(scope.filter(condition))
        rest = self.of_days(rows, days).filter(~F.coalesce(condition, F.lit(False)))
        self._put_days(name, self._aside(name, rest), days)

    def put_days(self, name: str, rows: DataFrame, days: list[str | None], load: str = WHOLE) -> None:
        """Make these days of a table what `rows` has of them."""
        self.repair(name)
        self._put_days(name, self._aside(name, self.of_days(placed(rows, load), days)), days)

    def put_loads(self, name: str, rows: DataFrame) -> None:
        """Make a table without times what `rows` (with load_id) says; `rows` may read this table."""
        self.repair(name)
        self._put_days(name, self._aside(name, rows.withColumn(DAY, F.lit(None).cast("date"))), [None])

    def _put_days(self, name: str, content: str, days: list[str | None]) -> None:
        """Make these days of a table the rows of the folder `content`, and no others."""
        if not days:
            return
        change = self.spark.createDataFrame([(self._entry(name)[1], days, content)], _RECORD)
        change.coalesce(1).write.mode("overwrite").json(self._change_path(name))
        self.repair(name)

    def _change_path(self, name: str) -> str:
        return f"{self.root}/redo/{name}"

    def _change(self, name: str) -> dict | None:
        """The change of days that is under way, if its record is finished and is about the newest generation."""
        if not finished(self.spark, self._change_path(name)):
            return None
        record = self.spark.read.schema(_RECORD).json(self._change_path(name)).first()
        return record.asDict() if record and record["generation"] == self._entry(name)[1] else None

    def repair(self, name: str) -> None:
        """Bring a change of days to its end: its own, or one that an earlier attempt left. Does nothing if there is none."""
        change = self._change(name)
        if change is not None:
            self._fill(name, change)
            remove(self.spark, self._change_path(name))
            last = change["content"].rsplit("/", 1)[1]  # stays until the next change: it may be being read
            for old in children(self.spark, f"{self.root}/aside/{name}"):
                if old != last:
                    remove(self.spark, f"{self.root}/aside/{name}/{old}")

    def _fill(self, name: str, change: dict) -> None:
        """Remove the days' folders and write all of them anew, in one job. Run again it comes to the same end."""
        path = self.path(name)
        _, generation, newest = self._entry(name)
        for number in range(1, newest + 1):
            for day in change["days"]:
                remove(self.spark, f"{self._shape_path(name, generation, number)}/{DAY}={day or _NO_DAY}")
        columns = with_folders(self.schema(name))
        self._write(self._files(change["content"], columns), path, "dynamic")

    def of_days(self, rows: DataFrame, days: list[str | None]) -> DataFrame:
        """The rows of these days, None standing for rows without a time."""
        return rows.filter(self._match(days))

    @staticmethod
    def _match(days: list[str | None]) -> Column:
        """Whether a row is of one of these days: TRUE or FALSE."""
        dates = [F.lit(d).cast("date") for d in days if d is not None]
        match = F.coalesce(F.col(DAY).isin(dates), F.lit(False)) if dates else F.lit(False)
        return match | F.col(DAY).isNull() if None in days else match

    def merge_loads(self, name: str, keep: str, at_least: int) -> None:
        """Give days with `at_least` loads one folder for all loads but `keep`, the one that may yet be run again."""
        self.repair(name)
        rows = self.read(name, with_folders=True).filter(F.col(LOAD) != keep)
        loads = rows.groupBy(DAY).agg(F.count_distinct(LOAD).alias("n"))
        days = self.days(loads.filter(F.col("n") >= at_least))
        if days:
            mark = F.when(F.col(LOAD) == keep, F.col(LOAD)).otherwise(F.lit(WHOLE))
            self._put_days(name, self._aside(name, self.of_days(self.read(name, with_folders=True), days).withColumn(LOAD, mark)), days)


def _balanced(df: DataFrame) -> DataFrame:
    """Few files for each day, yet a day that holds most of the rows is split."""
    return df.hint("rebalance", DAY)


def with_folders(schema: T.StructType) -> T.StructType:
    """These columns, then those of the folders."""
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), T.StructField(LOAD, T.StringType())])


def carried(rows: DataFrame, before: T.StructType, after: T.StructType) -> DataFrame:
    """Rows with the columns `before`, and those of the folders, as rows with the columns `after`."""
    kinds = {f.name: f.dataType for f in before}

    def column(f: T.StructField) -> Column:
        if f.name not in kinds:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if kinds[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)

    return rows.select(*map(column, after), DAY, LOAD)


def _widens(old: T.DataType, new: T.DataType) -> bool:
    a, b = old.simpleString(), new.simpleString()
    return b == "string" or (a in _WIDER and b in _WIDER and _WIDER.index(a) < _WIDER.index(b))


def _numbers(entry: str) -> tuple[int, int]:
    """Generation and shape of a schema entry."""
    _, generation, number = entry.split("-")
    return int(generation), int(number)


def time_column(schema: T.StructType) -> str | None:
    """The column that dates a row."""
    return next((t for t in _TIMES if t in schema.names), None)


def placed(df: DataFrame, load: str) -> DataFrame:
    """The rows with the folder they belong to."""
    time = time_column(df.schema)
    day = F.to_date(time) if time else F.lit(None).cast("date")
    return df.withColumn(DAY, day).withColumn(LOAD, F.lit(load))


def shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Make a DataFrame a view for SQL users, in place of an earlier view of that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
