"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millwatch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.dataFrameQueryContext.enabled", "false")  # call sites of column expressions
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """A fresh folder for tables and stream checkpoints, below the folder the cluster shares.

    The folder is the session's `spark.checkpoint.dir`. Only a local session without that setting
    falls back to a temporary folder: executors on other machines could not read it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="millwatch-")
    return f"{shared.rstrip('/')}/millwatch-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, as Spark itself finds it, and the path."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    system, folder = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written this folder to its end."""
    return "_SUCCESS" in children(spark, path)
