"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (equal texts here) enter the bins from the largest to the smallest; each goes to the bin with the least
remaining room that still holds it, found in a balanced tree of remaining rooms. The capacity is the smallest,
by bisection, with which the wanted number of bins is enough, so bins come out near equal.

Groups of one size are interchangeable, so the packing works on (size, number of groups) classes: whole runs
of a class enter a bin at once. The classes are counted by Spark; there are at most as many as distinct group
sizes, never as many as documents. Each group then gets its rank in its class, in parts of bounded size, and
looks up the run that holds the rank.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.llm.shared import stored

ROWS_PER_PART = 50_000
MAX_BROADCAST_RUNS = 100_000


class RoomTree:
    """Remaining rooms in order: an AVL-balanced multiset of (room, bin), least room first."""

    class Node:
        __slots__ = ("height", "key", "left", "right")

        def __init__(self, key):
            self.key, self.left, self.right, self.height = key, None, None, 1

    def __init__(self) -> None:
        self.root = None

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The entry with the least room of at least `size`."""
        node, found = self.root, None
        while node:
            if node.key[0] >= size:
                found, node = node.key, node.left
            else:
                node = node.right
        return found

    @staticmethod
    def _h(node) -> int:
        return node.height if node else 0

    def _fix(self, node):
        node.height = 1 + max(self._h(node.left), self._h(node.right))
        lean = self._h(node.left) - self._h(node.right)
        if lean > 1:
            if self._h(node.left.left) < self._h(node.left.right):
                node.left = self._turn(node.left, "right", "left")
            return self._turn(node, "left", "right")
        if lean < -1:
            if self._h(node.right.right) < self._h(node.right.left):
                node.right = self._turn(node.right, "left", "right")
            return self._turn(node, "right", "left")
        return node

    def _turn(self, node, up: str, down: str):
        top = getattr(node, up)
        setattr(node, up, getattr(top, down))
        setattr(top, down, node)
        for x in (node, top):
            x.height = 1 + max(self._h(x.left), self._h(x.right))
        return top

    def _add(self, node, key):
        if not node:
            return self.Node(key)
        if key < node.key:
            node.left = self._add(node.left, key)
        else:
            node.right = self._add(node.right, key)
        return self._fix(node)

    def _remove(self, node, key):
        if key < node.key:
            node.left = self._remove(node.left, key)
        elif key > node.key:
            node.right = self._remove(node.right, key)
        else:
            if not node.left or not node.right:
                return node.left or node.right
            least = node.right
            while least.left:
                least = least.left
            node.key = least.key
            node.right = self._remove(node.right, least.key)
        return self._fix(node)


def pack(classes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """Runs (size, first rank, count, bin) of the classes (size, count), largest size first; None if more than `most` bins are needed.

    A group that is larger than the capacity opens a bin of its own. After the bin with the tightest room
    took one group it is the tightest still, until the size no longer fits: so it takes a whole run.
    """
    tree, bins, runs = RoomTree(), 0, []
    for size, count in classes:
        rank = 0
        while rank < count:
            found = tree.tightest(size)
            if found:
                tree.remove(found)
                room, at = found
            else:
                if most is not None and bins == most:
                    return None
                room, at = max(capacity, size), bins
                bins += 1
            n = min(count - rank, room // size)
            runs.append((size, rank, n, at))
            tree.add((room - n * size, at))
            rank += n
    return runs


def smallest_capacity(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """The packing into at most `shards` bins with the smallest capacity that bisection finds."""
    total = sum(s * c for s, c in classes)
    low, high = max(1, -(-total // shards)), max(1, total)
    best = pack(classes, high, shards)
    while low < high:
        middle = (low + high) // 2
        got = pack(classes, middle, shards)
        if got is None:
            low = middle + 1
        else:
            best, high = got, middle
    return best


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """`name`: the rank of a row among those with equal `keys`, from 0, for keys of any frequency.

    Rows are ranked within parts (a hash of their order columns picks the part, the number of parts follows the
    rows), and the sizes of the earlier parts are added. Equal rows may change places.
    """
    parts = max(1, -(-df.count() // ROWS_PER_PART))
    cut = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = cut.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*keys, "_part").orderBy(*order)
    ranked = cut.withColumn("_rank", F.row_number().over(within) - 1)
    return ranked.join(offsets, [*keys, "_part"]).withColumn(name, (F.col("_rank") + F.col("_before")).cast("bigint")).drop("_rank", "_before", "_part")


def shard(docs: DataFrame, shards: int = 16, capacity: int | None = None) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard, slot. Equal texts stay together.

    Size: UTF-8 bytes plus 1, so nothing is free; a null text counts as empty and is grouped with empty ones.
    With `capacity` the number of bins is what best-fit-decreasing needs, else the capacity is the smallest
    for `shards` bins. A group larger than the capacity fills a bin alone. Repeated rows are kept; an empty
    table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("content")))
    groups = stored(rows.groupBy("size", "content").agg(F.count(F.lit(1)).alias("copies")).withColumn("bytes", F.col("size") * F.col("copies")))
    classes = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("groups")).orderBy(F.desc("bytes"))
    sizes = [(r["bytes"], r["groups"]) for r in classes.toLocalIterator()]
    runs = pack(sizes, capacity) if capacity else smallest_capacity(sizes, shards)
    spark = docs.sparkSession
    placed = stored(spark.createDataFrame(pd.DataFrame(runs, columns=["bytes", "first", "n", "shard"]).astype({"shard": "int32"}), "bytes bigint, first bigint, n bigint, shard int"))
    if len(runs) <= MAX_BROADCAST_RUNS:
        placed = F.broadcast(placed)
    ranked = numbered(groups, ["bytes"], [F.col("content"), F.col("size")], "rank")
    homes = ranked.join(placed, (ranked["bytes"] == placed["bytes"]) & (ranked["rank"] >= placed["first"]) & (ranked["rank"] < placed["first"] + placed["n"]))
    homes = homes.select("size", "content", "shard")
    sharded = rows.join(homes, ["size", "content"]).select("doc_id", "size", "text_crc32", "shard")
    return numbered(stored(sharded), ["shard"], [F.col("doc_id"), F.col("text_crc32")], "slot").select("doc_id", "size", "text_crc32", "shard", "slot")
