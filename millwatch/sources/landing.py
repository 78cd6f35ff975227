"""Landing files: comma separated text, one header row, append-only batches under a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from millwatch import schemas
from millwatch import settings as S
from millwatch.functions.text import null_tokens_to_null, to_event_time, to_number

RAW_LINE = "_raw_line"
_RAW = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in schemas.LANDING]
    + [T.StructField(RAW_LINE, T.StringType())]
)


def _configure(reader, sep: str, glob: str) -> DataFrameReader | DataStreamReader:
    # Quotes are plain characters in these files. `nullValue` takes one token, so all of the null
    # tokens are handled after the scan.
    return (
        reader.schema(_RAW)
        .option("header", True)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_LINE)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )


def read_landing_csv(
    spark: SparkSession, path: str | list[str], sep: str = ",", glob: str = S.LANDING_GLOB
) -> DataFrame:
    """All cells as text, with the raw line kept where its number of cells is wrong."""
    return _configure(spark.read, sep, glob).csv(path)


def stream_landing_csv(
    spark: SparkSession, path: str, sep: str = ",", glob: str = S.LANDING_GLOB,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same files as a stream: every file is read once."""
    reader = _configure(spark.readStream, sep, glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def with_provenance(df: DataFrame) -> DataFrame:
    """Load time and source file of every row; apply it to a file scan."""
    return df.withColumns(
        {"_loaded_at": F.current_timestamp(), "_file_name": F.col("_metadata.file_name")}
    )


def _parse(name: str, kind: T.DataType, cell: Column) -> Column:
    if isinstance(kind, T.DoubleType):
        return to_number(cell)
    if isinstance(kind, T.TimestampNTZType):
        return to_event_time(cell)
    limit = S.TEXT_LIMITS[name]
    return F.when(F.length(cell) <= limit, cell)


def parse_landing(raw: DataFrame, sep: str = ",") -> DataFrame:
    """Typed columns plus `reject_reason`, NULL for a good row. One projection over the scan.

    A row is bad when its number of cells is wrong, a filled cell does not parse, or a text is too
    long. Bad rows never fail the load.
    """
    cells = {f.name: null_tokens_to_null(F.col(f.name), S.NULL_TOKENS) for f in schemas.LANDING}
    typed = {f.name: _parse(f.name, f.dataType, cells[f.name]) for f in schemas.LANDING}
    bad_cells = [F.when(cells[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in cells]
    reason = F.when(F.col(RAW_LINE).isNotNull(), F.lit("cells")).otherwise(F.coalesce(*bad_cells))
    extra = [c for c in raw.columns if c not in cells and c != RAW_LINE]
    return raw.select(
        *[typed[n].alias(n) for n in cells],
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), F.coalesce(RAW_LINE, _rejoined_line(sep))).alias("raw_line"),
        *extra,
    )


def _rejoined_line(sep: str) -> Column:
    """The line as it was: with quotes off, cells are what stood between the separators."""
    return F.concat_ws(sep, *[F.coalesce(F.col(f.name), F.lit("")) for f in schemas.LANDING])


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_line")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("reject_reason", "raw_line")


def copy_into(raw: DataFrame, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows in the landing schema, rejected rows with reason and line). `sep` is that of the files."""
    parsed = parse_landing(raw, sep)
    return good_rows(parsed), rejected_rows(parsed)


def write_landing_batches(lines: DataFrame, path: str, sep: str = ",") -> None:
    """Write `line` texts as one folder of CSV part files per `batch` name, each with the header.

    Rebalancing on the batch splits a batch that is much larger than the others over many tasks.
    """
    header = sep.join(f.name for f in schemas.LANDING)
    (
        lines.select("batch", F.col("line").alias(header))
        .hint("rebalance", "batch")
        .write.partitionBy("batch")
        .option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .mode("append")
        .csv(path)
    )

