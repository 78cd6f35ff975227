"""Which landing files exist, which are new, and where the next batch continues.

A batch is a CSV file `…batch_<n>.csv`, or a folder of part files under such a name, as Spark writes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import settings as S
from millwatch.sources.landing import parse_landing, read_landing_csv
from millwatch.sources.tables import Store


def list_landing_files(spark: SparkSession, path: str, glob: str = S.LANDING_GLOB) -> DataFrame:
    """Paths of the landing files. `content` is not selected, so no file is opened for its bytes."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )


def numbered(files: DataFrame) -> DataFrame:
    """`path` with its `batch_no`; names without a number, or with number 0, are left out."""
    number = F.regexp_extract("path", S.BATCH_FILE_PATTERN, 1).try_cast("int")
    return files.select("path", number.alias("batch_no")).filter(F.col("batch_no") > 0)


def batch_name() -> Column:
    return F.regexp_extract("path", S.BATCH_FILE_PATTERN, 0)


def latest_batch(files: DataFrame) -> DataFrame:
    """One row: the highest batch number, compared as a number, and its name."""
    best = numbered(files).agg(
        F.max("batch_no").alias("batch_no"), F.max_by(batch_name(), "batch_no").alias("batch")
    )
    return best.filter(F.col("batch_no").isNotNull())


def new_files(current: DataFrame, processed: DataFrame) -> DataFrame:
    """Current paths the last run had not seen. The next cursor is `current` itself, not the union."""
    return current.select("path").distinct().join(processed.select("path"), "path", "left_anti")


def run_key(files: DataFrame) -> DataFrame:
    """One row naming a run by its new files, in sorted order; NULL when there are none.

    It is one text by its nature, as long as the names of the files of one run together.
    """
    names = F.array_sort(F.collect_list("path"))
    key = F.concat(F.lit(S.RUN_KEY_PREFIX), F.array_join(names, "_"))
    return files.agg(F.when(F.size(names) > 0, key).alias("run_key"))


CURSOR = "file_cursor"


def take_new(store: Store, current: DataFrame) -> DataFrame:
    """The paths that the stored cursor has not seen; the listing becomes the cursor if there are any."""
    seen = store.read(CURSOR) if store.exists(CURSOR) else current.limit(0)
    fresh = store.kept(new_files(current, seen))
    if not fresh.isEmpty():
        store.replace(CURSOR, current.select("path").distinct())
    return fresh


def batch_resume_point(
    spark: SparkSession, path: str, order: str = "file", glob: str = S.LANDING_GLOB
) -> DataFrame:
    """One row `(next_batch, last_timestamp)`; `(1, NULL)` when there is no batch yet.

    `order="file"` takes the timestamp of the last physical row of the latest batch (for a batch that is one
    file), `order="time"` its latest timestamp. The batch is a condition on the file names.
    """
    files = numbered(list_landing_files(spark, path, glob))
    top = files.agg(F.max("batch_no").alias("n")).first()["n"]
    if top is None:
        return spark.createDataFrame([(1, None)], "next_batch int, last_timestamp timestamp_ntz")
    number = F.regexp_extract(F.col("_metadata.file_path"), S.BATCH_FILE_PATTERN, 1)
    raw = read_landing_csv(spark, path, glob=glob).filter(number.try_cast("int") == top)
    if order == "time":
        last = F.max("timestamp")
    else:
        raw = raw.select(
            "*",
            F.struct(
                "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()
            ).alias("place"),
        )
        last = F.max_by("timestamp", "place")
    rows = parse_landing(raw)
    return rows.agg(F.lit(top + 1).alias("next_batch"), last.alias("last_timestamp"))
