"""Tables in the folder all executors share, and reading the inputs."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.session import workspace


ARROW_BYTES = 4 << 20  # of a batch that goes to a Python worker

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: Spark hands the file to every executor."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), "millwatch.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: work done once, and no lineage to redo when an executor is lost."""
    spark = df.sparkSession
    ship(spark)
    path = f"{workspace(spark)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A stored table with a broadcast hint if it has at most `rows` rows; else Spark joins it as it sees fit."""
    kept = stored(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def packed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, p, text): the whole row in one column, so that names cannot clash, and a 64-bit hash of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", F.xxhash64(text).alias("p"), text.alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """These names, each made longer until no column of `df` has it, whatever the case of its letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ARROW_BYTES instead of all texts of a partition: the JVM and the Python worker both hold a batch.

    Spark reads this where a query runs, so it stays set for the session. A limit that the session was given is left as it is.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(ARROW_BYTES))


def release() -> None:
    """Give memory that a Python worker no longer uses back to the system: Spark keeps the worker for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only one C library has it
        ctypes.CDLL(None).malloc_trim(0)
