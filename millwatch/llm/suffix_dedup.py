"""Removal of byte strings that occur twice, by a distributed merge sort of suffixes.

A suffix begins at each sampled place: of every LENGTH-byte window the place of the smallest hash of its GRAM-byte
strings (the last of equal ones). The choice depends on the window's bytes alone, so equal windows have a
suffix at the same place; it keeps 2 of about 100 suffixes.

1. The hashes at the places are counted; a hash that occurs once belongs to no repeat. A Bloom filter of the
   others picks the suffixes that are sorted (the distinguishing step of a distributed string sort).
2. Each task sorts its suffixes - the bytes after the place, then those before it, backwards - and sends the
   sorted run, front-coded, cut at splitters; equal suffixes of a run are sent once, marked as several. A task merges the pieces of its range with a loser tree that
   carries common prefix lengths and never compares known prefixes again.
3. In the merged order, neighbours with a common prefix of GRAM bytes or more form a group. All windows that
   contain the place are compared inside the group: by their bytes before and after the place, in batches of
   bounded size. Groups that a batch or a range border cuts leave their windows to a count in Spark.
4. What is found for a suffix goes back to all its places by a join on a hash of it.
5. Bytes of windows found twice go. Texts that are equal as a whole go whole.

Hashes of windows and of suffixes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.bloom import Bloom
from millwatch.llm.shared import packed, stored
from millwatch.llm.suffix_runs import decoded, front_coded, merged
from millwatch.llm.words import mix, signed, slices, texts_of, window_sums

LENGTH = 200
RUN = 40_000  # suffixes in a sorted run
BATCH = 16_384  # suffixes compared at once
PART = 40_000  # suffixes wanted in a range
MOST_PARTS = 16_384
SEGMENT = 1 << 19  # bytes of a text looked at together
_BASE = 0x9E3779B97F4A7C15
_MULT = 0xD6E8FEB86659FD93


def places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled places in joined texts (given by their bounds) and the hashes of the grams there."""
    span = length - gram + 1
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = window_sums(data, gram, _BASE)
    index = np.uint64(0xFFFFFFFF) - np.arange(len(sums), dtype=np.uint64)
    least = (sums & np.uint64(0xFFFFFFFF00000000)) | index
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    windows = len(sums) - span + 1
    least = np.minimum(least[:windows], least[span - width : span - width + windows])
    edges = np.zeros(windows + 1, np.int64)
    whole = ends - starts >= length
    np.add.at(edges, starts[whole], 1)
    np.add.at(edges, ends[whole] - length + 1, -1)
    chosen = np.zeros(len(sums), bool)
    chosen[(np.uint64(0xFFFFFFFF) - (least[np.cumsum(edges[:-1]) > 0] & np.uint64(0xFFFFFFFF))).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    return at, sums[at]


def sampled(texts: list[bytes], length: int, gram: int, segment: int = SEGMENT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, places, hashes), once for each text that has places; no place comes twice."""
    for number, found in groupby(_segments(texts, length, gram, segment), lambda x: x[0]):
        parts = list(found)
        if len(parts) > 1:  # neighbouring segments may both report a place
            at, first = np.unique(np.concatenate([a for _, a, _ in parts]), return_index=True)
            yield number, at, np.concatenate([h for _, _, h in parts])[first]
        else:
            yield parts[0]


def _segments(texts: list[bytes], length: int, gram: int, segment: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, places, hashes) in the order of the texts; long texts come in overlapping segments."""
    group: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ends = np.cumsum([len(part) for _, _, part in group])
        starts = ends - [len(part) for _, _, part in group]
        at, hashes = places(np.frombuffer(b"".join(part for _, _, part in group), np.uint8), starts, ends, length, gram)
        bounds = np.searchsorted(at, [*starts, ends[-1]])
        for (number, offset, _), start, a, b in zip(group, starts, bounds[:-1], bounds[1:], strict=True):
            if b > a:
                yield number, at[a:b] - start + offset, hashes[a:b]

    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), segment):
            part = text[offset : offset + segment + length - 1]
            if len(part) >= length:
                group.append((number, offset, part))
                size += len(part)
            if size >= segment:
                yield from flush()
                group, size = [], 0
    if group:
        yield from flush()


Suffix = tuple[bytes, int, int, int]  # key, bytes of it after the place, text, place


def representatives(run: list[Suffix]) -> tuple[list[bytes], list[int], list[int]]:
    """The distinct suffixes of a run in order, the bytes after their places, and 1 or, for several places, 2."""
    keys: list[bytes] = []
    rights: list[int] = []
    many: list[int] = []
    for key, right, *_ in sorted(set(run)):  # copies of one text give equal suffixes
        if keys and right == rights[-1] and key == keys[-1]:
            many[-1] = 2
        else:
            keys.append(key)
            rights.append(right)
            many.append(1)
    return keys, rights, many


def suffix_hash(key: bytes, right: int) -> int:
    return xxhash.xxh3_64_intdigest(key, right)


class Context:
    """How suffix keys are made and taken apart."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram, self.before = length, gram, length - gram
        self.width = length + self.before

    def key(self, text: bytes, at: int) -> tuple[bytes, int]:
        """The bytes from the place on, then those before it backwards; and the number of the former."""
        right = text[at : at + self.length]
        return right + text[max(0, at - self.before) : at][::-1], len(right)

    def window_hashes(self, keys: list[bytes], rights: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of bytes before the place: the hash of that window of each key, and which keys have it."""
        n = len(keys)
        right = np.frombuffer(b"".join(k[:r].ljust(self.length, b"\0") for k, r in zip(keys, rights.tolist(), strict=True)), np.uint8).reshape(n, -1)
        left = np.frombuffer(b"".join(k[r:].ljust(self.before, b"\0") for k, r in zip(keys, rights.tolist(), strict=True)), np.uint8).reshape(n, -1)
        lefts = np.fromiter((len(k) for k in keys), np.int64, n) - rights
        powers = np.cumprod(np.full(self.length, _MULT, np.uint64))
        head = (right[:, : self.gram].astype(np.uint64) * powers[: self.gram]).sum(axis=1, dtype=np.uint64)
        tail = np.zeros((n, self.before + 1), np.uint64)
        np.cumsum((right[:, self.gram :].astype(np.uint64) + np.uint64(1)) * powers[self.gram :], axis=1, out=tail[:, 1:])
        back = np.zeros((n, self.before + 1), np.uint64)
        np.cumsum((left.astype(np.uint64) + np.uint64(1)) * powers[: self.before], axis=1, out=back[:, 1:])
        for before in range(self.before + 1):
            rest = self.before - before
            hashes = mix(mix(head + tail[:, rest]) + mix(back[:, before] + np.uint64(before)) * np.uint64(_MULT))
            yield before, hashes, (lefts >= before) & (rights >= self.gram + rest)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left, null if unchanged), kept_text (kept
    without cut characters), p (hash of the text).

    Null and empty texts have no bytes. Texts shorter than `length` stay. Repeated rows are equal texts.
    Ids may be null or repeated: results depend on the texts alone. Kept bytes may cut a character. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    gram = length // 2
    make = Context(length, gram)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("p", F.xxhash64("text"))
    facts = stored(rows.select("doc_id", "p", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256")))
    copied = facts.where(F.col("n_bytes") >= length).groupBy("whole_sha256").agg(F.count(F.lit(1)).alias("copies"), F.min("p").alias("p")).where("copies > 1")
    copied = stored(copied)
    texts = rows.select("p", "text").where(F.octet_length("text") >= length)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            p = batch.column("p").to_numpy()
            out = [(p[number], *np.unique(hashes, return_counts=True)) for number, _, hashes in sampled(texts_of(batch), length, gram)]
            hashes = np.concatenate([np.empty(0, np.uint64), *(h for _, h, _ in out)])
            counts = np.concatenate([np.empty(0, np.int64), *(c for _, _, c in out)])
            owners = np.repeat(np.array([o for o, _, _ in out], np.int64), [len(h) for _, h, _ in out])
            yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(owners), pa.array(counts > 1)], names=["h", "p", "again"])

    counted = texts.mapInArrow(grams, "h bigint, p bigint, again boolean").groupBy("h").agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.max("again").alias("again"))
    shared = stored(counted.where("lo < hi OR again").select("h"))
    n_shared = shared.count()
    filled = Bloom(shared, n_shared)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[Suffix]:
        """The suffixes that may be repeated."""
        for batch in slices(batches, "text"):
            p, data = batch.column("p").to_pylist(), texts_of(batch)
            for number, at, hashes in sampled(data, length, gram):
                for place in at[filled.has(hashes)].tolist():
                    yield *make.key(data[number], place), p[number], place

    parts = min(MOST_PARTS, max(1, 4 * n_shared // PART))
    share = min(1.0, (2000 + 32 * parts) / max(1, 4 * n_shared))

    def only_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [key for key, *_ in suffixes(batches)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])

    seen = sorted(bytes(r["key"]) for r in texts.sample(share, seed=7).mapInArrow(only_keys, "key binary").toLocalIterator()) if parts > 1 else []
    splitters = sorted({seen[len(seen) * i // parts] for i in range(1, parts)}) if seen else []

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import bisect

        def send(run: list[Suffix]) -> pa.RecordBatch:
            keys, rights, many = representatives(run)
            borders = [0, *(bisect.bisect_left(keys, s) for s in splitters), len(keys)]
            pieces = [(i, a, b) for i, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)) if b > a]
            coded = [front_coded(keys[a:b], make.width) for _, a, b in pieces]
            columns = [pa.array([i for i, _, _ in pieces], pa.int32())]
            columns += [pa.array([c[j] for c in coded], pa.binary()) for j in range(3)]
            for numbers, kind in ((rights, np.uint16), (many, np.uint8)):
                columns.append(pa.array([np.array(numbers[a:b], kind).tobytes() for _, a, b in pieces], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["part", "shared", "lengths", "tails", "rights", "many"])

        run: list[Suffix] = []
        for suffix in suffixes(batches):
            run.append(suffix)
            if len(run) >= RUN:
                yield send(run)
                run = []
        if run:
            yield send(run)

    blocks = "part int, shared binary, lengths binary, tails binary, rights binary, many binary"

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(k, p, at): the hash of each suffix and its place."""

        def send(run: list[Suffix]) -> pa.RecordBatch:
            rows = sorted(set(run))
            hashes = np.array([suffix_hash(key, right) for key, right, *_ in rows], np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(signed(hashes)), *(pa.array([x[j] for x in rows], pa.int64()) for j in (2, 3))], names=["k", "p", "at"])

        run: list[Suffix] = []
        for suffix in suffixes(batches):
            run.append(suffix)
            if len(run) >= RUN:
                yield send(run)
                run = []
        if run:
            yield send(run)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(suffix, bytes before its place, after it) of repeated windows; windows of cut groups with hash and weight besides."""
        pieces: dict[int, list[dict]] = {}
        for batch in batches:
            for piece in batch.to_pylist():
                pieces.setdefault(piece["part"], []).append(piece)
        for part in sorted(pieces):
            yield from merged_range(pieces.pop(part))

    def merged_range(pieces: list[dict]) -> Iterator[pa.RecordBatch]:
        owners = [zip(np.frombuffer(piece["rights"], np.uint16).tolist(), np.frombuffer(piece["many"], np.uint8).tolist(), strict=True) for piece in pieces]
        keys: list[bytes] = []
        rights: list[int] = []
        weights: list[int] = []
        group: list[int] = []
        number, first_open = 0, True

        def compare(last_open: bool) -> pa.RecordBatch:
            """Windows of the batch; its first and last group are cut if so marked."""
            r, g, many = np.array(rights, np.int64), np.array(group, np.int64), np.array(weights, np.int64)
            sizes = np.bincount(g - g[0], weights=many)
            cut = np.zeros(len(keys), bool)
            cut |= (g == g[0]) & first_open
            cut |= (g == g[-1]) & last_open
            use = np.flatnonzero(cut | (sizes[g - g[0]] > 1))
            far_left, far_right = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
            hashed = np.zeros(len(keys), np.uint64)
            hashed[use] = [suffix_hash(keys[i], rights[i]) for i in use]
            open_key, open_before, open_hash, open_weight = [], [], [], []
            if len(use):
                for before, hashes, has in make.window_hashes([keys[i] for i in use], r[use]):
                    mine = use[has]
                    _, inverse = np.unique(hashes[has], return_inverse=True)
                    total = np.bincount(inverse, weights=many[mine])[inverse] if len(mine) else np.empty(0)
                    twice = mine[total > 1]
                    far_left[twice] = before
                    far_right[twice] = np.maximum(far_right[twice], length - before)
                    lone_cut = (total == 1) & cut[mine]
                    heads = np.zeros(len(mine), bool)
                    heads[np.unique(inverse, return_index=True)[1]] = True
                    sent = lone_cut | (heads & (total > 1) & cut[mine])
                    if sent.any():
                        open_key.append(hashed[mine[sent]])
                        open_before.append(np.full(int(sent.sum()), before, np.int64))
                        open_hash.append(signed(mix(hashes[has][sent] + np.uint64(before))))
                        open_weight.append(np.minimum(total[sent], 2).astype(np.int32))
            hit = far_left >= 0
            known, n_open = int(hit.sum()), sum(map(len, open_key))
            empty = np.empty(0, np.int64)
            lefts = np.concatenate([far_left[hit], *open_before, empty])
            afters = np.concatenate([far_right[hit], *(length - before for before in open_before), empty])
            hashes = pa.array(np.concatenate([np.zeros(known, np.int64), *open_hash, empty]).astype(np.int64), mask=np.arange(known + n_open) < known)
            found = pa.array(np.concatenate([np.full(known, 2, np.int32), *open_weight]).astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate([hashed[hit], *open_key]))), pa.array(lefts), pa.array(afters), hashes, found], names=["k", "before", "after", "w", "weight"])

        decoders = [decoded(piece["shared"], piece["lengths"], piece["tails"]) for piece in pieces]
        for prefix, key, run in merged(decoders):
            right, many = next(owners[run])
            if keys and prefix == len(key) == len(keys[-1]) and right == rights[-1]:
                weights[-1] += many
                continue
            if prefix < gram:
                number += 1
            if len(keys) >= BATCH:
                yield compare(prefix >= gram)
                keys, rights, weights, group, first_open = [], [], [], [], prefix >= gram
            keys.append(key)
            rights.append(right)
            weights.append(many)
            group.append(number)
        if keys:
            yield compare(True)

    sorted_runs = texts.mapInArrow(runs, blocks).repartition(max(1, len(splitters) + 1), "part")
    found = stored(sorted_runs.mapInArrow(merge, "k bigint, before bigint, after bigint, w bigint, weight int"))
    twice = found.where("w IS NOT NULL").groupBy("w").agg(F.sum("weight").alias("total")).where("total > 1").select("w")
    judged = found.where("w IS NULL").select("k", "before", "after").unionByName(found.where("weight = 1").join(twice, "w").select("k", "before", "after"))
    judged = stored(judged.groupBy("k").agg(F.max("before").alias("before"), F.max("after").alias("after")))  # windows of a place overlap there
    spans = texts.mapInArrow(owned, "k bigint, p bigint, at bigint").join(judged, "k").select("p", (F.col("at") - F.col("before")).alias("first"), (F.col("at") + F.col("after")).alias("last"))
    spans = stored(spans.join(copied.select("p"), "p", "left_anti").groupBy("p").agg(F.collect_set(F.struct("first", "last")).alias("spans")))
    touched = Bloom(spans.select(F.col("p").alias("h")), spans.count())

    def only_touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(touched.has(batch.column("p").to_numpy().view(np.uint64))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs_of, sums, kept, readable = [], [], [], [], []
            for text, found_spans in zip(texts_of(batch), batch.column("spans"), strict=True):
                bounds = found_spans.values.flatten()
                first, last = bounds[0].to_numpy(), bounds[1].to_numpy()
                order = np.argsort(first)
                first, last = first[order], np.maximum.accumulate(last[order])
                opens = np.r_[True, first[1:] > last[:-1]]
                starts, ends = first[opens], last[np.r_[np.flatnonzero(opens)[1:] - 1, len(last) - 1]]
                left = b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True))
                removed.append(len(text) - len(left))
                runs_of.append(len(starts))
                sums.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
                readable.append(left.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(removed, pa.int64()), pa.array(runs_of, pa.int64()), pa.array(sums), pa.array(kept, pa.binary()), pa.array(readable, pa.string())], names=["p", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"])

    touched_texts = texts.select("p", "text").mapInArrow(only_touched, "p bigint, text string")
    cuts = touched_texts.join(spans, "p").select("p", "text", "spans").mapInArrow(cut, "p bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, kept_text string").dropDuplicates(["p"])
    whole = F.col("copies").isNotNull()
    rated = facts.join(copied.drop("p"), "whole_sha256", "left").join(cuts, "p", "left")
    return rated.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        "p",
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of `docs` with what remove_repeats() leaves of their texts; rows with nothing left go, unless they were empty before."""
    changed = remove_repeats(docs, length).where("n_removed > 0").select("p", "kept_text").dropDuplicates(["p"])
    rows = packed(docs).select("row", "p").join(changed, "p", "left").where("kept_text IS NULL OR kept_text <> ''")
    return rows.select(F.when(F.col("kept_text").isNull(), F.col("row")).otherwise(F.col("row").withField("text", F.col("kept_text"))).alias("row")).select("row.*")
