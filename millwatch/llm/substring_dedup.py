"""Substring dedup of word sequences by difference-cover anchors.

A window is WINDOW consecutive words. With a difference cover D modulo PERIOD, for any two positions i and j
there is a shift below PERIOD that moves both onto D. So hashing only the sub-windows of WINDOW - PERIOD + 1
words that begin at cover positions is enough: two equal windows contain an equal, equally placed anchor.

1. Anchors of all texts are counted by hash; those of at least two different texts are shared. A text whose
   word sequence is that of a smaller document goes whole.
2. Shared anchors extend: each whole window that contains one at a fitting shift is hashed, and the smallest
   document with it found. Anchors that no other text has are held back by a Bloom filter of the shared ones.
3. A window that also begins in a smaller document marks its words; the words left are joined again.

Counting and smallest documents combine before the shuffle, so a passage in any share of the documents does not
gather in one task. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.bloom import Bloom
from millwatch.llm.shared import stored
from millwatch.llm.words import WordHashes, signed, texts_of, window_sums

WINDOW = 50
PERIOD = 31
_BASE = 0x9E3779B97F4A7C15
_WIDE = 0xC2B2AE3D27D4EB4F


def difference_cover(period: int) -> list[int]:
    """Residues whose pairwise differences give every residue: each step adds the one that gives most new ones."""
    cover, have = [0], {0}
    while len(have) < period:
        gains = {c: len({d % period for x in cover for d in (c - x, x - c)} - have) for c in range(period) if c not in cover}
        best = max(gains, key=lambda c: (gains[c], -c))
        have |= {d % period for x in cover for d in (best - x, x - best)}
        cover.append(best)
    return sorted(cover)


def anchor_rows(hashes: np.ndarray, window: int, period: int, cover: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one text."""
    if len(hashes) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = window_sums(hashes, window - period + 1, _BASE)
    at = np.flatnonzero(np.isin(np.arange(period), cover)[np.arange(len(sums)) % period])
    return at, sums[at]


def keyed(docs: DataFrame) -> DataFrame:
    """doc (the id, the largest long for null), tag (tells rows of one id apart), p (64-bit hash of the text), text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(2**63 - 1)).cast("bigint").alias("doc"), F.xxhash64("text").alias("p"), "text")


def remove_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, kept (the text left, null where nothing was removed).

    Null and empty texts have no words. A row with a null id gives way to every document with an id and to
    none without. Rows of one id never remove words from each other; repeated rows get the same result.
    Texts under `window` words keep all their words. An empty table gives an empty result.
    """
    if not 0 < period <= window:
        raise ValueError("the period must not exceed the window")
    cover = difference_cover(period)
    rows = keyed(docs)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.split() for t in texts_of(batch)]
            sums = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "doc", "p")), pa.array([len(w) for w in words], pa.int64()), pa.array(sums)], names=["doc_id", "doc", "p", "n_words", "whole_sha256"])

    facts = stored(rows.mapInArrow(measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, doc bigint, p bigint, n_words bigint, whole_sha256 string"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            found = [np.unique(anchor_rows(memo.of(t.split()), window, period, cover)[1]) for t in texts_of(batch)]
            p = np.repeat(batch.column("p").to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate([np.empty(0, np.uint64), *found]))), pa.array(p)], names=["h", "p"])

    shared = rows.select("p", "text").mapInArrow(anchors, "h bigint, p bigint").groupBy("h").agg(F.min("p").alias("a"), F.max("p").alias("b")).where("a < b")
    shared = stored(shared.select("h"))
    filled = Bloom(shared, shared.count())

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            for row, text in enumerate(texts_of(batch)):
                hashes = memo.of(text.split())
                at, keys = anchor_rows(hashes, window, period, cover)
                at = at[filled.has(keys)]
                if len(at):
                    last = len(hashes) - window
                    edges = np.zeros(last + 2, np.int64)
                    np.add.at(edges, np.maximum(at - period + 1, 0), 1)
                    np.add.at(edges, np.minimum(at, last) + 1, -1)
                    starts = np.flatnonzero(np.cumsum(edges)[:-1] > 0)
                    out.append((row, starts, window_sums(hashes, window, _WIDE)[starts]))
            index = pa.array(np.repeat([r for r, _, _ in out], [len(s) for _, s, _ in out]).astype(np.int64))
            starts = np.concatenate([np.empty(0, np.int64), *(s for _, s, _ in out)])
            sums = np.concatenate([np.empty(0, np.uint64), *(w for _, _, w in out)])
            tag = pa.array((batch.column("p").to_numpy() & 0x7FFFFFFF).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(signed(sums)), batch.column("doc").take(index), tag.take(index), pa.array(starts.astype(np.int32))], names=["w", "doc", "tag", "start"])

    found = stored(rows.select("doc", "p", "text").mapInArrow(windows, "w bigint, doc bigint, tag int, start int"))
    firsts = found.groupBy("w").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("w", "first")
    marked = found.join(firsts, "w").where("doc > first").groupBy("doc", "tag").agg(F.collect_list("start").alias("starts"))
    marked = stored(marked)
    keys = marked.select(F.xxhash64("doc", "tag").alias("h"))
    touched = Bloom(keys, marked.count())

    def only_touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = touched.has(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
            yield batch.filter(pa.array(keep))

    texts = rows.withColumn("tag", F.col("p").bitwiseAND(0x7FFFFFFF).cast("int")).select("doc", "tag", "p", "text")
    texts = texts.withColumn("key", F.xxhash64("doc", "tag")).mapInArrow(only_touched, "doc bigint, tag int, p bigint, text string, key bigint")
    texts = texts.dropDuplicates(["doc", "p"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, starts in zip(texts_of(batch), batch.column("starts"), strict=True):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                at = starts.values.to_numpy()
                np.add.at(gone, at, 1)
                np.add.at(gone, at + window, -1)
                left = np.cumsum(gone)[:-1] == 0
                removed.append(len(words) - int(left.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(left)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("p"), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc", "p", "n_removed", "kept_sha256", "kept"])

    cuts = texts.join(marked, ["doc", "tag"]).select("doc", "p", "text", "starts").mapInArrow(cut, "doc bigint, p bigint, n_removed bigint, kept_sha256 string, kept string")
    firsts = facts.groupBy("whole_sha256").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    copied = facts.join(firsts, "whole_sha256", "left")
    copied = copied.withColumn("whole", F.coalesce((F.col("doc") > F.col("first")) & (F.col("n_words") >= window), F.lit(False)))
    return copied.join(cuts, ["doc", "p"], "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("whole"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(F.col("whole"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
