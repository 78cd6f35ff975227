"""Backup, damage, recovery of the days of a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.sources.tables import DAY, Store

COPIES_PER_TASK = 1_000_000


def back_up(store: Store, name: str, backup: str, days: list[str | None]) -> None:
    """Copy the days that are about to change to an ordinary table."""
    rows = store.read(name, with_folders=True)
    store.replace(backup, store.of_days(rows, days).drop(DAY, "load_id"))


def restore(store: Store, name: str, backup: str, days: list[str | None]) -> None:
    """Put the backed up days in place of the damaged ones."""
    store.put_days(name, store.read(backup), days)


def missing_rows(store: Store, name: str, backup: str, days: list[str | None]) -> DataFrame:
    """Rows, with their multiplicity, that only the backup of these days still has."""
    now = store.of_days(store.read(name, with_folders=True), days).drop(DAY, "load_id")
    return all_but(store.read(backup), now)


def all_but(rows: DataFrame, gone: DataFrame, copies: int = COPIES_PER_TASK) -> DataFrame:
    """Rows without as many equal rows of the other side (EXCEPT ALL).

    Equal rows are counted before the shuffle. Where very many are left they are written out in parts,
    each by a task of its own, so that a row copied billions of times does not hold up one task.
    """
    columns = rows.columns
    left = (
        rows.withColumn("n", F.lit(1))
        .unionByName(gone.withColumn("n", F.lit(-1)))
        .groupBy(*columns)
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > 0)
    )
    few = left.filter(F.col("n") <= copies)
    parts = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / copies))
    many = (
        left.filter(F.col("n") > copies)
        .withColumn("part", F.explode(parts))
        .withColumn("n", F.least(F.lit(copies), F.col("n") - F.col("part") * copies))
        .repartition("part", *columns)
        .drop("part")
    )
    each = F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))
    return few.unionByName(many).withColumn("copy", each).select(*columns)
