"""Row windows over time in blocks of bounded size, so that one machine's readings are no single task's work.

Rows are numbered over time within each key: first inside time slots of fixed length, then the sizes of the
earlier slots are added. The number picks a block of BLOCK_ROWS rows; the last rows of a block are copied to the next
one, so every frame of up to `back` preceding rows is complete. The ranks inside one slot of one key are one task's work,
whatever its size. The plan is the same at any size and nothing
runs while it is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_ROWS = 1_000_000


def over_time(
    df: DataFrame,
    key: str,
    time: str,
    back: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    descending: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`df` plus `columns(window)`, the window running over time within each key.

    `columns` may look at the current row and up to `back` rows before it. Rows with equal time are ordered by
    their other columns. A missing value counts as the highest.
    """
    if back >= block_rows:
        raise ValueError("a block must be longer than a frame")
    ordering = [time, *[c for c in df.columns if c not in (key, time)]]
    slot = F.date_diff(F.to_date(time), F.lit("1970-01-01").cast("date")) * 24 + F.hour(time)
    slotted = df.withColumn("slot", slot)
    sizes = slotted.groupBy(F.col(key).alias("of_key"), F.col("slot").alias("of_slot")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("of_key").orderBy(*_order(["of_slot"], descending)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("of_key", "of_slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy(key, "slot").orderBy(*_order(ordering, descending))
    ranked = slotted.withColumn("place", F.row_number().over(within) - 1)
    match = F.col(key).eqNullSafe(F.col("of_key")) & F.col("slot").eqNullSafe(F.col("of_slot"))
    numbered = ranked.join(offsets, match).withColumn("place", F.col("place") + F.col("before"))
    own = F.floor(F.col("place") / block_rows)
    near_end = F.col("place") % block_rows >= block_rows - back
    blocks = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("own", own).withColumn("block", F.explode(blocks))
    window = Window.partitionBy(key, "block").orderBy("place")
    return (
        spread.withColumns(columns(window))
        .filter(F.col("block") == F.col("own"))
        .drop("slot", "of_key", "of_slot", "before", "place", "own", "block")
    )


def _order(columns: list[str], descending: bool) -> list[Column]:
    if descending:
        return [F.col(c).desc_nulls_first() for c in columns]
    return [F.col(c).asc_nulls_last() for c in columns]
