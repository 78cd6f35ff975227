"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

An item is found in a document when the document has at least PERCENT of the item's distinct word shingles, no
matter how long the document is. An item shorter than a shingle is one shingle of its own length, which is looked for
among the document's runs of that length. Items are partitioned by size (powers of two); all items of a partition have
bottom-k MinHash sketches of one length, chosen from the partition's largest size u as k = 2 * (u - ceil(PERCENT
of u) + 1). A document that contains an item of n shingles misses at most n - ceil(PERCENT of n) of them, so it
has at least that many fewer than k of the sketch: that is the test for candidates, which misses none. Candidates are
verified by the exact containment of shingle texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.shared import packed, small, stored

SHINGLE = 5
PERCENT = 80
MOST_BROADCAST_ROWS = 1_000_000  # of two longs each
_SPACE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Lower-cased words; none for a null text."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def hashes(column: str, size: int) -> Column:
    """The hash of each run of `size` words of an array column; none if there are fewer words."""
    runs = F.transform(F.sequence(F.lit(0), F.size(column) - size), lambda i: F.xxhash64(*(F.get(F.col(column), i + k) for k in range(size))))
    return F.when(F.size(column) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def shingles(column: str, size: int) -> Column:
    """The distinct runs of `size` words as text."""
    runs = F.transform(F.sequence(F.lit(1), F.size(column) - size + 1), lambda i: F.array_join(F.slice(F.col(column), i, size), " "))
    return F.array_distinct(F.when(F.size(column) >= size, runs).otherwise(F.array().cast("array<string>")))


def item_shingles(column: str, size: int) -> Column:
    """The shingles of an item; all words as one if they are fewer."""
    words = F.col(column)
    whole = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(words) >= size, shingles(column, size)).otherwise(whole)


def item_hashes(column: str, size: int) -> Column:
    """The hashes of an item's shingles."""
    return F.coalesce(*(F.when(F.size(column) >= k, hashes(column, k)) for k in range(size, 0, -1)), F.array().cast("array<bigint>"))


def found_items(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, n_shared, n_item (shingles of the item).

    Null and empty texts contain nothing; items without words are found nowhere. Rows of one
    doc_id, or of one item_id, are judged each and reported once, with the largest n_shared. A null doc_id
    or item_id is reported as null. Empty tables give an empty result.
    """
    exact = _matches(docs, items, shingle, percent)
    pairs = packed(docs).select("doc_id", "p").join(small(exact, MOST_BROADCAST_ROWS), "p")
    return pairs.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n").cast("bigint").alias("n_item"))


def without_items(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that contain none of the items."""
    found = small(_matches(docs, items, shingle, percent).select("p").distinct(), MOST_BROADCAST_ROWS)
    return packed(docs).select("row", "p").join(found, "p", "left_anti").select("row.*")


def _matches(docs: DataFrame, items: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(p, item_id, n_shared, n) for each text, by its hash, and item it contains."""
    listed = items.select("item_id", words(F.col("text")).alias("words")).withColumn("texts", item_shingles("words", shingle))
    listed = listed.withColumn("n", F.size("texts")).where("n > 0").withColumn("item", F.xxhash64("item_id", F.array_sort("texts")))
    listed = listed.withColumn("largest", (2 * F.pow(F.lit(2), F.floor(F.log2("n")))).cast("int") - 1)
    fewest = lambda n: F.expr(f"({percent} * {n} + 99) div 100")
    listed = listed.withColumn("k", F.least(F.col("n"), (2 * (F.col("largest") - fewest("largest") + 1)).cast("int")))
    listed = stored(listed.withColumn("need", F.col("k") - (F.col("n") - fewest("n"))).dropDuplicates(["item"]))
    hashed = listed.select("item", "need", "k", F.array_sort(F.array_distinct(item_hashes("words", shingle))).alias("hashes"))
    sketches = hashed.select("item", "need", F.explode(F.slice(F.col("hashes"), F.lit(1), F.col("k"))).alias("h"))

    lengths = [r["k"] for r in listed.select(F.least(F.size("words"), F.lit(shingle)).alias("k")).distinct().collect()]  # `shingle` rows at most
    lengths = sorted(lengths) or [shingle]
    rows = packed(docs).select("p", "text")
    seen = rows.select("p", words(F.col("text")).alias("words")).select("p", F.explode(F.concat(*(hashes("words", k) for k in lengths))).alias("h"))
    hits = seen.join(small(sketches, MOST_BROADCAST_ROWS), "h").groupBy("p", "item").agg(F.count_distinct("h").alias("hits"), F.first("need").alias("need"))
    candidates = stored(hits.where("hits >= need").select("p", "item"))

    chosen = rows.join(small(candidates.select("p").distinct(), MOST_BROADCAST_ROWS), "p", "left_semi").dropDuplicates(["p"])
    runs = chosen.select("p", words(F.col("text")).alias("words")).select("p", F.explode(F.concat(*(shingles("words", k) for k in lengths))).alias("s"))
    parts = listed.select("item", F.explode("texts").alias("s"))
    shared = runs.join(small(parts, MOST_BROADCAST_ROWS), "s").groupBy("p", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    exact = shared.join(candidates, ["p", "item"]).join(listed.select("item", "item_id", "n"), "item").where(F.col("n_shared") * 100 >= percent * F.col("n"))
    return exact.select("p", "item_id", "n_shared", "n")
