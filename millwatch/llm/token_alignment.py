"""Alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

A is a byte-level BPE (its rank file), B a SentencePiece model. A encodes a space and the text, B puts that space itself.
Special strings inside texts are plain text. The ends of both token sequences, as byte offsets, are two rising lists; offsets
in both of them are cuts, the tokens between two cuts are a group, and the two tokens that end at a cut are a link.

1. Texts are encoded once. Their merge of A ends and B ends is divided by diagonals: every STEPS steps a binary search finds how
   many ends of A and of B lie before (a pair of equal ends is not parted). So a text of any length becomes pieces of equal
   work, stored as rows of their own. Pieces of texts with several of them are dealt anew over all tasks; a text with one
   piece stays where it is.
2. Each piece is merged by itself, many in one go. Its links are counted by pair of ids, combined in the task before the
   shuffle; the sums are the corpus-wide counts, and each B id has its highest.
3. The pieces are merged again with the counts at hand. The MOST_PAIRS commonest pairs travel to the tasks, what
   lies beyond is joined. A piece gives its whole groups as text, and the open ends before its first and after its
   last cut; those are stitched to the neighbours of the same text.

Texts that are null or empty, or that either tokenizer does not give back byte by byte, have no tokens: zeros and
an empty string. Repeated rows are aligned each and each counts. An empty table gives an empty result. Only doc_id and text
are read; other columns do not pass through, so no name can clash. Memory follows the longest text, whose encoding is one call.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.shared import ship, stored
from millwatch.llm.words import slices, texts_of

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
STEPS = 1 << 14  # of the merge in one piece
MOST_PAIRS = 2_000_000  # about 17 bytes each
KEEP = 1_000_000  # pairs a task counts before it sends them on
SLICE = 1 << 20  # bytes of texts or ids looked at together

#: fixed value: the pattern that goes with the rank file
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Lengths = tuple[np.ndarray, np.ndarray]  # the number of bytes of each A id and each B id

_PIECES = "row bigint, doc_id bigint, piece int, pieces int, a binary, b binary, a_start bigint, b_start bigint"


class Tokenizers:
    """Both models: what tasks need to encode texts, and the bytes of each id. Loaded from files where the job is set up."""

    def __init__(self, ranks: str, model: str) -> None:
        with open(ranks, "rb") as f:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        with open(model, "rb") as f:
            self.proto = f.read()
        self._loaded = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_loaded": None}

    def load(self) -> tuple:
        """Encoders of both, and the list of B's token bytes."""
        if self._loaded is None:
            import sentencepiece
            import tiktoken

            a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
            b = sentencepiece.SentencePieceProcessor(model_proto=self.proto)
            self._loaded = a, b, self.b_bytes(b)
        return self._loaded

    @staticmethod
    def b_bytes(b) -> list[bytes]:
        return [bytes([int(t[1:-1], 16)]) if b.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(b.id_to_piece(list(range(b.get_piece_size()))))]

    def lengths(self) -> Lengths:
        a = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for word, i in self.ranks.items():
            a[i] = len(word)
        return a, np.array([len(x) for x in self.load()[2]], np.int64)


def diagonal(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[int, int]:
    """How many of `a` and of `b`, both rising, are the first `steps` of their merge; one more if that would part equals.

    Of equal values the one of `a` comes first.
    """
    low, high = max(0, steps - len(b)), min(steps, len(a))
    while low < high:
        i = (low + high) // 2
        if a[i] <= b[steps - i - 1]:
            low = i + 1
        else:
            high = i
    i, j = low, steps - low
    if i and j < len(b) and a[i - 1] == b[j]:
        j += 1
    return i, j


def cut_points(a: np.ndarray, b: np.ndarray, steps: int) -> list[tuple[int, int]]:
    """The borders of the pieces of two rising lists, first and last included."""
    inner = {diagonal(a, b, k) for k in range(steps, len(a) + len(b), steps)}
    return sorted({(0, 0), (len(a), len(b)), *inner})


def id_kind(lengths: Lengths) -> type:
    """What ids are stored as: 16 bits if both vocabularies allow it."""
    return np.uint16 if max(map(len, lengths)) <= 1 << 16 else np.int32


def pieces_of(docs: DataFrame, tokenizers: Tokenizers, lengths: Lengths, steps: int) -> DataFrame:
    """The encoded texts in pieces: the ids of A and B as numbers of fixed width, and the byte offset before the first of each.

    A text without tokens is one empty piece. `row` tells rows with equal doc_id apart.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tokenizers)
    a_lengths, b_lengths = lengths
    kind = id_kind(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, b_bytes = sent.value.load()
        for batch in slices(batches, "text", SLICE):
            texts = texts_of(batch)
            plain = [t.decode("utf-8", "replace") for t in texts]
            out: list[tuple] = []
            for row, doc, text, letters, b in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id")), texts, plain, second.encode(plain, num_threads=1), strict=True):
                a = first.encode_ordinary(" " + letters) if text else []
                if not text or b"".join(map(b_bytes.__getitem__, b)) != b" " + text or first.decode_bytes(a) != b" " + text:
                    out.append((row, doc, 0, 1, b"", b"", 0, 0))
                    continue
                a_ids, b_ids = np.array(a, kind), np.array(b, kind)
                a_ends, b_ends = np.cumsum(a_lengths[a_ids]), np.cumsum(b_lengths[b_ids])
                cuts = cut_points(a_ends, b_ends, steps)
                for k, ((i, j), (p, q)) in enumerate(zip(cuts, cuts[1:])):
                    starts = int(a_ends[i - 1]) if i else 0, int(b_ends[j - 1]) if j else 0
                    out.append((row, doc, k, len(cuts) - 1, a_ids[i:p].tobytes(), b_ids[j:q].tobytes(), *starts))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _PIECES.split(", ")])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return numbered.mapInArrow(run, _PIECES)


class Merged:
    """The pieces of a batch, merged in one go: their ends are moved so that those of the next piece come after."""

    def __init__(self, batch: pa.RecordBatch, lengths: Lengths) -> None:
        (a_lengths, b_lengths), kind = lengths, id_kind(lengths)
        a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
        a_start, b_start = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a_start", "b_start"))
        self.a_sizes, self.b_sizes = (np.array([len(x) // kind().itemsize for x in side], np.int64) for side in (a, b))
        self.a_ids, self.b_ids = (np.frombuffer(b"".join(side), kind).astype(np.int64) for side in (a, b))
        a_bytes, b_bytes = a_lengths[self.a_ids], b_lengths[self.b_ids]
        a_rows, b_rows = np.repeat(np.arange(len(a)), self.a_sizes), np.repeat(np.arange(len(b)), self.b_sizes)
        self.a_stop, self.b_stop = np.cumsum(self.a_sizes), np.cumsum(self.b_sizes)
        a_sums, b_sums = np.concatenate([[0], np.cumsum(a_bytes)]), np.concatenate([[0], np.cumsum(b_bytes)])
        a_in, b_in = (sums[stop] - sums[stop - size] for sums, stop, size in ((a_sums, self.a_stop, self.a_sizes), (b_sums, self.b_stop, self.b_sizes)))
        span = np.maximum(a_start + a_in, b_start + b_in) - np.minimum(a_start, b_start) + 1
        base = np.cumsum(span) - span - np.minimum(a_start, b_start)
        a_ends = a_sums[1:] + (base + a_start - a_sums[self.a_stop - self.a_sizes])[a_rows]
        b_ends = b_sums[1:] + (base + b_start - b_sums[self.b_stop - self.b_sizes])[b_rows]
        at = np.minimum(np.searchsorted(b_ends, a_ends), max(0, len(b_ends) - 1))
        hit = b_ends[at] == a_ends if len(b_ends) else np.zeros(len(a_ends), bool)
        self.link_a = np.flatnonzero(hit)
        self.link_b = at[hit]
        self.link_row = a_rows[self.link_a]
        self.pairs = self.a_ids[self.link_a] << 32 | self.b_ids[self.link_b]
        self.links = np.bincount(self.link_row, minlength=len(a))

    def digits(self) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """All tokens as text: A's and B's by turns, group by group, each with the mark after it (`,` `|` `;`).

        With it the place where the text of each token ends: of A's, of B's. The fourth part tells, for each piece, where it begins.
        An open last group is written like a whole one. Pieces begin a group of their own.
        """
        n_a, n_b, n = len(self.a_ids), len(self.b_ids), len(self.a_sizes)
        closing_a, closing_b = np.zeros(n_a + 1, np.int64), np.zeros(n_b + 1, np.int64)
        closing_a[self.link_a + 1] = 1
        closing_b[self.link_b + 1] = 1
        a_rows, b_rows = np.repeat(np.arange(n), self.a_sizes), np.repeat(np.arange(n), self.b_sizes)
        a_group = np.cumsum(closing_a)[:-1] + a_rows  # rising over all pieces, equal for the A and B tokens of one group
        b_group = np.cumsum(closing_b)[:-1] + b_rows
        groups = len(self.link_a) + n
        b_before = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=groups))])
        a_through = np.cumsum(np.bincount(a_group, minlength=groups))
        place_a, place_b = np.arange(n_a) + b_before[a_group], np.arange(n_b) + a_through[b_group]
        out = np.empty(n_a + n_b, np.int64)
        marks = np.full(n_a + n_b, ord(","), np.uint8)
        out[place_a], out[place_b] = self.a_ids, self.b_ids
        last_a = np.flatnonzero(np.diff(a_group, append=-1) != 0)
        last_b = np.flatnonzero(np.diff(b_group, append=-1) != 0)
        marks[place_a[last_a]] = ord("|")
        marks[place_b[last_b]] = ord(";")
        width = len(str(int(out.max()))) if len(out) else 1
        text = np.zeros((len(out), width + 1), np.uint8)
        for k in range(width):
            unit = 10**k
            text[:, width - 1 - k] = np.where((out >= unit) | (k == 0), out // unit % 10 + 48, 0)
        text[:, width] = marks
        stops = np.cumsum((text != 0).sum(axis=1))
        flat = text.ravel()
        begins = np.concatenate([[0], stops])[(self.a_stop - self.a_sizes) + (self.b_stop - self.b_sizes)]
        return flat[flat != 0].tobytes(), stops[place_a], stops[place_b], begins


def pair_counts(pieces: DataFrame, lengths: Lengths) -> DataFrame:
    """(pair, n, best): how many links hold each pair of ids, and whether no other pair with its B id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def combined() -> tuple[np.ndarray, np.ndarray]:
            fresh, n = np.unique(np.concatenate([np.empty(0, np.int64), *held]), return_counts=True)
            both, back = np.unique(np.concatenate([keys, fresh]), return_inverse=True)
            sums = np.zeros(len(both), np.int64)
            np.add.at(sums, back, np.concatenate([counts, n]))
            return both, sums

        for batch in slices(batches, "a", SLICE):
            held.append(Merged(batch, lengths).pairs)
            size += len(held[-1])
            if size > KEEP:
                keys, counts = combined()
                held, size = [], 0
                if len(keys) > KEEP:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])
                    keys, counts = keys[:0], counts[:0]
        keys, counts = combined()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

    counted = stored(pieces.select("a", "b", "a_start", "b_start").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    of_b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counted.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))  # one row per id of a vocabulary
    return stored(counted.join(F.broadcast(highest), of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def commonest(counted: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """At most `most` pairs with the highest counts, by classes of like counts, and the rest if there is one."""
    if counted.count() <= most:
        return counted, None
    grade = F.floor(8 * F.log2("n"))
    total, least = 0, None
    for row in counted.groupBy(grade.alias("grade")).count().orderBy(F.desc("grade")).collect():  # a few hundred rows at most
        total += row["count"]
        if total > most:
            break
        least = row["grade"]
    common = grade >= least if least is not None else F.lit(False)
    return counted.where(common), counted.where(~common)


_RESULT = (
    "row bigint, doc_id bigint, piece int, pieces int, n_a bigint, n_b bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups string, first_a string, first_b string, last_a string, last_b string"
)


def align(docs: DataFrame, ranks: str = RANKS, model: str = MODEL, steps: int = STEPS, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (`a1,a2|b1;a3|b2,b3`)."""
    spark = docs.sparkSession
    ship(spark)
    tokenizers = Tokenizers(ranks, model)
    lengths = tokenizers.lengths()
    kept = stored(pieces_of(docs, tokenizers, lengths, steps))
    single, several = kept.where("pieces = 1"), kept.where("pieces > 1").repartition("row", "piece")
    counted = pair_counts(single.unionByName(several), lengths)
    common, rare = commonest(counted, most_pairs)
    keys, counts, bests = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
    for block in _blocks(common).toLocalIterator():
        keys.append(np.frombuffer(block["keys"], np.int64))
        counts.append(np.frombuffer(block["counts"], np.int64))
        bests.append(np.frombuffer(block["bests"], bool))
    order = np.argsort(np.concatenate(keys))
    sent = spark.sparkContext.broadcast(tuple(np.concatenate(x)[order] for x in (keys, counts, bests)))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, bests = sent.value
        for batch in slices(batches, "a", SLICE):
            m, n = Merged(batch, lengths), batch.num_rows
            at = np.minimum(np.searchsorted(keys, m.pairs), max(0, len(keys) - 1))
            known = keys[at] == m.pairs if len(keys) else np.zeros(len(m.pairs), bool)
            best = np.bincount(m.link_row[known], weights=bests[at[known]], minlength=n).astype(np.int64)
            sums = np.zeros(n, np.int64)
            np.add.at(sums, m.link_row[known], counts[at[known]])
            text, a_stops, b_stops, begins = m.digits()
            ends = np.append(begins[1:], len(text))
            groups, open_ends = [], [[None] * n for _ in range(4)]
            first_link = np.cumsum(m.links) - m.links
            for k, pieces in enumerate(batch.column("pieces").to_pylist()):
                begin, end = int(begins[k]), int(ends[k])
                if pieces == 1:
                    groups.append(text[begin : max(begin, end - 1)].decode())
                    continue
                a0, b0, a1, b1 = int(m.a_stop[k] - m.a_sizes[k]), int(m.b_stop[k] - m.b_sizes[k]), int(m.a_stop[k]), int(m.b_stop[k])
                ids = [",".join(map(str, side)) for side in _open_ends(m, k, int(first_link[k]), a0, b0, a1, b1)]
                for side, value in zip(open_ends, ids):
                    side[k] = value
                if m.links[k] > 1:  # the groups between the first cut and the last one
                    first, last = int(first_link[k]), int(first_link[k] + m.links[k] - 1)
                    groups.append(text[int(b_stops[m.link_b[first]]) : int(b_stops[m.link_b[last]]) - 1].decode())
                else:
                    groups.append("")
            plain = [batch.column(c) for c in ("row", "doc_id", "piece", "pieces")]
            numbers = [pa.array(x.astype(np.int64)) for x in (m.a_sizes, m.b_sizes, m.links, best, sums)]
            texts = [pa.array(x, pa.string()) for x in (groups, *open_ends)]
            yield pa.RecordBatch.from_arrays([*plain, *numbers, *texts], names=[f.split()[0] for f in _RESULT.split(", ")])

    result = ["row", "doc_id", "n_a", "n_b", "n_links", "n_best", "count_sum", "groups"]
    whole = single.mapInArrow(run, _RESULT).select(*result).unionByName(_stitched(several.mapInArrow(run, _RESULT)).select(*result))
    if rare is not None:
        whole = _with_rare(whole, single.unionByName(several), lengths, sent, rare)
    return whole.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups")


def _open_ends(m: Merged, k: int, link: int, a0: int, b0: int, a1: int, b1: int) -> tuple[np.ndarray, ...]:
    """The ids of a piece up to its first cut, and after its last one: A's and B's. Without a cut all are before it."""
    if not m.links[k]:
        return m.a_ids[a0:a1], m.b_ids[b0:b1], m.a_ids[:0], m.b_ids[:0]
    last = link + int(m.links[k]) - 1
    return m.a_ids[a0 : m.link_a[link] + 1], m.b_ids[b0 : m.link_b[link] + 1], m.a_ids[m.link_a[last] + 1 : a1], m.b_ids[m.link_b[last] + 1 : b1]


def _blocks(counted: DataFrame) -> DataFrame:
    """Pairs in compact form: what travels to the tasks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n, best = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
            columns = [np.ascontiguousarray(x).tobytes() for x in (pair, n, best.astype(bool))]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["keys", "counts", "bests"])

    return counted.mapInArrow(pack, "keys binary, counts binary, bests binary")


def _with_rare(whole: DataFrame, pieces: DataFrame, lengths: Lengths, sent: Broadcast, rare: DataFrame) -> DataFrame:
    """Adds the counts of links whose pair did not travel: no such pair is common, so the join has no hot key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value[0]
        for batch in slices(batches, "a", SLICE):
            m = Merged(batch, lengths)
            unknown = ~np.isin(m.pairs, keys)
            rows = batch.column("row").to_numpy()[m.link_row[unknown]]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(m.pairs[unknown])], names=["row", "pair"])

    found = pieces.mapInArrow(run, "row bigint, pair bigint").join(rare, "pair")
    sums = found.groupBy("row").agg(F.sum("n").alias("more"), F.count_if("best").alias("more_best"))
    added = {"count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)), "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0))}
    return whole.join(sums, "row", "left").withColumns(added)


def _stitched(pieces: DataFrame) -> DataFrame:
    """One row per text of several pieces: an open end goes on in the next piece until that has a cut."""
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_links", "n_best", "count_sum")]
    parts = F.sort_array(F.collect_list(F.struct("piece", F.col("n_links").alias("links"), "groups", "first_a", "first_b", "last_a", "last_b")))
    texts = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *sums, parts.alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [stitched(parts) for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], names=[*batch.schema.names[:-1], "groups"])

    schema = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    return texts.mapInArrow(run, schema)


def stitched(parts: list[dict]) -> str:
    """The groups of a text from those of its pieces, in order."""
    out: list[str] = []
    open_a: list[str] = []
    open_b: list[str] = []
    for part in parts:
        open_a.append(part["first_a"])
        open_b.append(part["first_b"])
        if part["links"]:
            out.append("|".join(",".join(filter(None, side)) for side in (open_a, open_b)))
            out.append(part["groups"])
            open_a, open_b = [part["last_a"]], [part["last_b"]]
    return ";".join(filter(None, out))
