"""Connected components of an edge table, by alternating large and small stars.

Each step is one minimum per node, combined before the shuffle, and one join; a node with very many edges is
split by the join, nothing is gathered per node. Every step is written to the shared folder. An edge table of at
most FEW_EDGES rows (16 MB), which is counted first, is joined up by one task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.shared import stored


FEW_EDGES = 1_000_000


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all edges of one task, by union-find; roots are the smallest nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    nodes = [n for n in root if find(n) != n]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())], names=["node", "root"])


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star over edges (a, b)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    down = stored(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
    return small.select("e.a", "e.b").where("a <> b").distinct()


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) for edges (a, b) of longs: root is the smallest node that is reachable. Loops and repeats do no harm.

    Nodes that are their own root are left out.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if now.count() <= few:
        return now.coalesce(1).mapInArrow(_joined_up, "node bigint, root bigint")
    before = None
    while True:
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not seen["n"] or seen == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, now = seen, stored(_stars(now))
