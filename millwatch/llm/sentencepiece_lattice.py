"""SentencePiece encoding and decoding over a relational lattice.

A space is put before each text, as the model's normaliser does, and stands for the piece table's U+2581. Texts are
cut into words: a run of spaces with the run of other characters after it, and again wherever no piece holds the two
characters around a place. No piece crosses these cuts, so the best segmentation of a text is that of its
words, whatever their length.

1. The distinct words are counted. From each place of a word the substrings up to the longest piece with the same first
   three characters are exploded and equi-joined to the piece table; a single character without a piece gets an edge with the score of an
   unknown one, to be spelled in byte pieces. The edges are grouped by word (rows keep the partitioning by word, so nothing is
   shuffled again) and folded with `aggregate`: the best score and last edge up to each character. Of equal scores the longer last piece wins.
   Pieces that no best path can have, because shorter ones do better on the same characters, are left out before.
2. A word of more than MOST_CHARS characters is named by its hash and goes in chunks of CHUNK characters: edges are grouped
   by word and chunk, and the fold over the chunks hands on the scores of the last places, as many as a piece is long. All words
   keep back pointers instead of paths, so work and memory are linear in the word.
3. Words go back into the texts in order. The most frequent ones, MOST_WORDS in all (a long word counts as
   several), travel as one compact broadcast; words beyond that bound are joined to the documents that have them.

Decoding joins the pieces' bytes and drops the first space. It restores every text exactly: U+2581 and line breaks
in a text are spelled in bytes.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm.shared import free_names, release, ship, small_batches, stored
from millwatch.llm.words import slices, texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MOST_WORDS = 6_000_000  # about 25 bytes each
UNKNOWN_PENALTY = 10.0
ROUNDING = 1e-6  # of a score: far more than sums of doubles lose
MOST_CHARS = 64  # of a word that is its own key and is folded in one go
CHUNK = 32  # characters of a longer word folded together
GROUPS = 20_000
PLAN_TEXT = 20_000
KEEP = 60_000  # words a task counts before it sends them
KNOWN = 300_000  # words a task remembers the ids of; only saves time
AT_ONCE = 20_000  # words cut together
BUCKETS = 1 << 15
UNKNOWN = 1 << 30  # plus the code point: a character without a piece
SLICE = 1 << 20  # bytes of texts looked at together
_WORD = re.compile(rb" *[^ \n]+| +|\n+")


class Pieces:
    """The piece table of a model file: read once where the job is set up, a few tens of thousands of rows."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.byte_ids = [0] * 256
        self.bytes_of: list[bytes] = [b""] * size
        self.rows: list[tuple[str, int, float]] = []
        for i in range(size):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(text[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain = text.replace("▁", " ")
                self.bytes_of[i] = plain.encode()
                self.rows.append((plain, i, float(sp.get_score(i))))
        if any(" " in piece.lstrip(" ") or "\n" in piece for piece, _, _ in self.rows):
            raise ValueError("a piece crosses the words: spaces may only begin a piece")
        self.scores = [0.0] * size
        for _, i, score in self.rows:
            self.scores[i] = score
        self.unknown = min(s for _, _, s in self.rows) - UNKNOWN_PENALTY
        self.edges = self.undominated()
        self.pairs = frozenset(p[i : i + 2] for p, _ in self.edges for i in range(len(p) - 1))
        self.bounds = sorted({len(p) for p, _ in self.edges})  # the lengths these pieces have

    def undominated(self) -> list[tuple[str, int]]:
        """The pieces that a best path can have: all but those whose own characters have a better path of shorter pieces.

        Such a path would be better in any text, so leaving these pieces out changes no best path and no tie.
        """
        score = {p: s for p, _, s in self.rows}

        def split(p: str) -> float:
            best = [0.0]
            for j in range(1, len(p) + 1):
                ways = [best[i] + score.get(p[i:j], self.unknown if j - i == 1 else -math.inf) for i in range(j) if j - i < len(p)]
                best.append(max(ways))
            return best[-1]

        return [(p, i) for p, i, s in self.rows if len(p) == 1 or split(p) <= s + ROUNDING * (1 + abs(s))]

    def longest_by_start(self) -> list[int]:
        """The longest piece, by a hash of its first three characters."""
        out = [2] * BUCKETS
        for p, _ in self.edges:
            if len(p) > 2:
                at = zlib.crc32(p[:3].encode()) % BUCKETS
                out[at] = max(out[at], len(p))
        return out

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        """The words of a text before they are cut, as keys that word_of() reads.

        A key that begins with neither space nor line break stands for itself after one space: so most texts are
        simply split. One space before a key marks the word after it as it is.
        """
        if not text:
            return []
        lines = b" " + text.replace(b"\n", b" \n")
        if b"  " in lines:
            return [b" " + w for w in _WORD.findall(b" " + text)]
        return lines[1:].split(b" ")

    @staticmethod
    def word_of(key: bytes) -> str:
        return (key[1:] if key[:1] == b" " else key if key[:1] == b"\n" else b" " + key).decode("utf-8", "replace")


def spelled(byte_ids: list[int], pointers: list[int]) -> list[int]:
    """The ids of a path, given as back pointers (length * 2^32 + piece), which are followed from the last one."""
    path, j = [], len(pointers)
    while j:
        path.append(pointers[j - 1] & 0xFFFFFFFF)
        j -= pointers[j - 1] >> 32
    path.reverse()
    if max(path) < UNKNOWN:
        return path
    return [i for last in path for i in ([last] if last < UNKNOWN else [byte_ids[b] for b in chr(last - UNKNOWN).encode()])]


class Cuts:
    """Cuts words between two characters that no piece holds side by side; many words at once."""

    def __init__(self, pairs: frozenset[str]) -> None:
        self.chars = sorted({c for pair in pairs for c in pair})
        number = {c: i for i, c in enumerate(self.chars, 1)}
        self.held = np.zeros((len(self.chars) + 1, len(self.chars) + 1), bool)
        for a, b in pairs:
            self.held[number[a], number[b]] = True

    def start(self) -> Callable[[list[str]], tuple[list[str], list[int]]]:
        """To be called once in a task: a function that gives the parts of all words in order and, for each word, where its parts end."""
        width, held = len(self.held), self.held.ravel()
        numbers = np.zeros(0x110000, np.int32)  # of code points; zero: in no pair
        numbers[[ord(c) for c in self.chars]] = np.arange(1, width)

        def cut(words: list[str]) -> tuple[list[str], list[int]]:
            joined = "".join(words)
            kinds = numbers[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
            closed = np.ones(len(kinds), bool)
            closed[:-1] = ~held[kinds[:-1] * width + kinds[1:]]
            closed[ends - 1] = True
            places = np.flatnonzero(closed) + 1
            stops = places.tolist()
            return [joined[a:b] for a, b in zip([0, *stops], stops)], np.searchsorted(places, ends, "right").tolist()

        return cut


def key_of(word: str) -> str:
    """What names a word in tables: itself, or its hash after a line break, which no word of several kinds of characters begins with."""
    return word if len(word) <= MOST_CHARS else "\n" + hashlib.sha256(word.encode()).hexdigest()


def constant(values: list, kind: str) -> Column:
    """An array known when the query is planned: one text that the optimiser takes apart once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def counted_words(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, n, size): the distinct words of all texts, how many batches of texts have them, and their length.

    The length is an aggregate, so a filter on it stays above the shuffle, which all readers of the words then share.
    """
    cuts, words, word_of = Cuts(pieces.pairs), pieces.words, pieces.word_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: set[bytes] = set()
        cut = cuts.start()

        def send() -> pa.RecordBatch:
            parts: set[str] = set()
            while keys:  # some at a time, so that little is held twice
                parts.update(cut([word_of(keys.pop()) for _ in range(min(len(keys), AT_ONCE))])[0])
            return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string())], names=["word"])

        for batch in slices(batches, "text", SLICE):
            for text in texts_of(batch):
                keys.update(words(text))
            if len(keys) > KEEP:
                yield send()
        if keys:
            yield send()
        batch = keys = cut = None  # else they outlive the release
        release()

    return docs.select("text").mapInArrow(run, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("word")).alias("size"))


def edges_of(places: DataFrame, pieces: Pieces, *keep: str) -> DataFrame:
    """(key, *keep, at, edge): the lattice. `places` has key, off, text: characters of a word after the first `off`.

    Edges start at the first CHUNK characters of longer texts, else at all. `at` is the place of the edge's last character
    in its word, counted from zero. An edge is one number: the place of its end in its chunk, its length and its piece.
    """
    rows = [pa.array([p for p, _ in pieces.edges], pa.string()), pa.array([i for _, i in pieces.edges], pa.int32())]
    table = places.sparkSession.createDataFrame(pa.Table.from_arrays(rows, names=["piece", "id"]))  # a list of rows would start Python workers of another kind
    longest = F.get(constant(pieces.longest_by_start(), "int"), F.pmod(F.crc32(F.left("rest", F.lit(3))), F.lit(BUCKETS)).cast("int"))
    count = F.when(F.length("text") <= MOST_CHARS, F.length("text")).otherwise(CHUNK)
    starts = places.select("key", *keep, "off", "text", F.explode(F.sequence(F.lit(1), count)).alias("start"))
    starts = starts.withColumn("rest", F.substr("text", F.col("start"), F.lit(pieces.bounds[-1])))
    ended = starts.select("key", *keep, "off", "start", "rest", F.explode(F.sequence(F.lit(1), F.least(longest, F.length("rest")))).alias("len"))
    substrings = ended.select("key", *keep, (F.col("off") + F.col("start") + F.col("len") - 2).alias("at"), "len", F.left("rest", F.col("len")).alias("piece"))
    edges = substrings.join(F.broadcast(table), "piece", "left").where("id IS NOT NULL OR len = 1")
    return edges.select("key", *keep, "at", "len", F.coalesce(F.col("id"), UNKNOWN + F.ascii("piece")).alias("last"))


def packed_edge(chunk: int) -> Column:
    """(place of the end in its chunk) * 2^40 + length * 2^32 + piece."""
    return (F.col("at") % chunk + 1).cast("bigint") * 2**40 + F.col("len") * 2**32 + F.col("last")


def best_paths(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, n, path): the best segmentation of each word, by the lattice; `word` is its key, spelled() follows the path.

    The fold goes from character to character: among the edges that end there it takes the best score, of equal ones
    the longest piece. A word of up to MOST_CHARS characters is one pass over its sorted edges, which carries the best scores
    and edges of the characters before and the best edge so far to the present one.
    """
    length, last = "int(shiftright(e, 32) & 255)", "int(e & 4294967295)"
    score = f"get(best, size(best) - {length}).score + if({last} >= {UNKNOWN}, {pieces.unknown}D, get(scores, {last}))"
    begin = "array(named_struct('score', 0D, 'len', 0, 'last', 0))"

    def step(edges: str) -> str:
        ending = f"transform(filter({edges}, e -> shiftright(e, 40) = j), e -> named_struct('score', {score}, 'len', {length}, 'last', {last}))"
        return f"(best, j) -> array_append(best, array_max({ending}))"

    def pointers(places: str) -> str:
        return f"transform({places}, b -> bigint(b.len) * 4294967296 + b.last)"

    scores = constant(pieces.scores, "double")
    short = words.where(F.col("size") <= MOST_CHARS).select(F.col("word").alias("key"), "n", F.lit(0).alias("off"), F.col("word").alias("text"))
    edges = F.sort_array(F.collect_list(packed_edge(MOST_CHARS)))  # by end, then length: the first edge of each end has one character
    lattice = edges_of(short, pieces, "n").groupBy("key").agg(F.first("n").alias("n"), edges.alias("edges"))
    worth = f"coalesce(get(scores, int(e & 4294967295)), {pieces.unknown}D)"  # a character without a piece lies beyond the scores
    sum_ = f"element_at(acc.best, -int(shiftright(e, 32) & 255)) + {worth}"
    back = "array_append(acc.back, acc.e & 1099511627775)"
    start = "named_struct('best', cast(array() AS array<double>), 'back', cast(array() AS array<bigint>), 'score', 0D, 'e', 0L)"
    next_end = f"named_struct('best', array_append(acc.best, acc.score), 'back', if(acc.e = 0, acc.back, {back}), 'score', acc.score + {worth}, 'e', e)"
    better = f"if({sum_} >= acc.score, named_struct('best', acc.best, 'back', acc.back, 'score', {sum_}, 'e', e), acc)"
    fold = f"aggregate(edges, {start}, (acc, e) -> if((shiftright(e, 32) & 255) = 1, {next_end}, {better}), acc -> {back})"
    folded = lattice.withColumn("scores", scores).select(F.col("key").alias("word"), "n", F.expr(fold).alias("path"))

    most = pieces.bounds[-1]
    chunks = f"transform(sequence(0, (length(word) - 1) div {CHUNK}), c -> named_struct('off', c * {CHUNK}, 'text', rpad(substr(word, c * {CHUNK} + 1, {CHUNK + most - 1}), {MOST_CHARS + most}, '\0')))"
    name = F.concat(F.lit("\n"), F.sha2("word", 256))
    long = words.where(F.col("size") > MOST_CHARS).select(name.alias("key"), "n", "size", F.explode(F.expr(chunks)).alias("c"))
    parts = edges_of(long.select("key", "n", "size", "c.*"), pieces, "n", "size").where(F.col("at") < F.col("size"))
    by_chunk = parts.groupBy("key", F.floor(F.col("at") / CHUNK).alias("chunk")).agg(F.first("n").alias("n"), F.max(F.col("at") % CHUNK + 1).alias("size"), F.collect_list(packed_edge(CHUNK)).alias("edges"))
    whole = by_chunk.groupBy("key").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("chunk", "size", "edges"))).alias("chunks"))
    out = pointers("slice(best, size(acc.window) + 1, c.size)")
    after = f"best -> named_struct('window', slice(best, greatest(1, size(best) - {most - 1}), {most}), 'out', array_append(acc.out, {out}))"
    chunk = f"(acc, c) -> aggregate(sequence(1, c.size), acc.window, {step('c.edges')}, {after})"
    fold = f"aggregate(chunks, named_struct('window', {begin}, 'out', cast(array() AS array<array<bigint>>)), {chunk}, acc -> flatten(acc.out))"
    return folded.unionByName(whole.withColumn("scores", scores).select(F.col("key").alias("word"), "n", F.expr(fold).alias("path")))


Words = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # sorted 64-bit hashes, where their ids start, how many, joined ids


def followed(paths: pa.ListArray, spell: Callable[[list[int]], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids that back pointers lead to, joined, and how many each path has. Short paths are followed together, a step at a time."""
    flat, offsets = paths.flatten().to_numpy(), paths.offsets.to_numpy().astype(np.int64)
    starts, at = offsets[:-1] - offsets[0], offsets[1:] - offsets[0] - 1
    ids, sizes, taken = flat & 0xFFFFFFFF, flat >> 32, np.zeros(len(flat), bool)
    odd = at - starts >= MOST_CHARS
    starts_left, at = starts[~odd], at[~odd]
    while len(at):
        taken[at] = True
        at = at - sizes[at]
        going = at >= starts_left
        starts_left, at = starts_left[going], at[going]
    row = np.repeat(np.arange(len(starts)), np.diff(offsets))
    odd[row[taken & (ids >= UNKNOWN)]] = True  # characters without a piece are spelled
    lengths = np.bincount(row[taken], minlength=len(starts))
    if not odd.any():
        return ids[taken], lengths
    plain = np.split(ids[taken], np.cumsum(lengths)[:-1])
    for i in np.flatnonzero(odd).tolist():
        plain[i] = np.array(spell(flat[offsets[i] - offsets[0] : offsets[i + 1] - offsets[0]].tolist()), np.int64)
    return np.concatenate(plain), np.fromiter(map(len, plain), np.int64, len(plain))


def packed_words(encoded: DataFrame, spell: Callable[[list[int]], list[int]], ids_below: int) -> Words:
    """Words and their ids in compact form: what travels to the tasks. Only hashes and places are sorted here, the ids stay as the tasks sent them."""
    kind = np.uint16 if ids_below <= 1 << 16 else np.int32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, batch.column("word").to_pylist()), np.uint64, batch.num_rows)
            flat, lengths = followed(batch.column("path"), spell)
            columns = [keys.tobytes(), lengths.astype(np.uint32).tobytes(), flat.astype(kind).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["keys", "lengths", "ids"])
        batch = keys = flat = lengths = columns = None
        release()

    blocks = encoded.select("word", "path").mapInArrow(pack, "keys binary, lengths binary, ids binary")
    parts: tuple[list, list, list] = ([np.empty(0, np.uint64)], [np.empty(0, np.uint32)], [np.empty(0, kind)])
    for row in blocks.toLocalIterator():
        for into, data in zip(parts, row, strict=True):
            into.append(np.frombuffer(data, into[0].dtype))
    joined = []
    for part in parts:  # one after the other, so that little is held twice
        joined.append(np.concatenate(part))
        part.clear()
    keys, lengths, ids = joined
    joined.clear()
    starts = np.cumsum(lengths, dtype=np.uint32 if len(ids) < 1 << 32 else np.int64) - lengths
    order = np.argsort(keys)
    return keys[order], starts[order], lengths[order], ids


def find_words(packed: Words, words: list[str]) -> list[bytes | None]:
    """The ids of each word as 32-bit numbers, None where it has none."""
    all_keys, all_starts, all_lengths, ids = packed
    if not len(all_keys) or not words:
        return [None] * len(words)
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    order = np.argsort(keys)  # neighbours are looked up one after the other
    at = np.empty(len(keys), np.int64)
    at[order] = np.minimum(np.searchsorted(all_keys, keys[order]), len(all_keys) - 1)
    hit = all_keys[at] == keys
    starts, lengths = all_starts[at].astype(np.int64), np.where(hit, all_lengths[at], 0).astype(np.int64)
    stops = np.cumsum(lengths)
    flat = ids[np.repeat(starts - (stops - lengths), lengths) + np.arange(int(stops[-1]))].astype(np.int32).tobytes()
    stops = (4 * stops).tolist()
    return [flat[a:b] if h else None for h, a, b in zip(hit.tolist(), [0, *stops[:-1]], stops, strict=True)]


@contextmanager
def lattice_settings(spark: SparkSession) -> Iterator[None]:
    """Settings for the lattice. Lists are collected by hash for GROUPS groups in a task before Spark sorts: words are short, so that
    is little memory. Plans are shown up to PLAN_TEXT characters: the driver keeps these texts, and the piece table's arrays are in them.
    """
    wanted = {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": str(GROUPS), "spark.sql.maxPlanStringLength": str(PLAN_TEXT)}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def encode(docs: DataFrame, model: str = MODEL, most_words: int = MOST_WORDS) -> DataFrame:
    """The rows of `docs` with a column `ids` (array<int>) after their own columns; a column of that name is replaced.

    Null and empty texts have no ids. Repeated rows are encoded each. An empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    small_batches(spark)
    pieces = Pieces(model)
    release()  # what an earlier call left in the driver's Python
    with lattice_settings(spark):
        encoded = stored(best_paths(counted_words(docs, pieces), pieces))
    frequent, rare = encoded, None
    room = F.sum(1 + F.floor(F.size("path") / MOST_CHARS)).alias("room")
    if (encoded.agg(room).first()["room"] or 0) > most_words:
        grade = F.floor(8 * F.log2("n"))
        kept, least = 0, None
        for row in encoded.groupBy(grade.alias("grade")).agg(room).orderBy(F.desc("grade")).collect():  # a few hundred rows at most
            kept += row["room"]
            if kept > most_words:
                break
            least = row["grade"]
        common = (grade >= least) if least is not None else F.lit(False)
        frequent, rare = encoded.where(common), encoded.where(~common).select("word", "path")
    spell = partial(spelled, pieces.byte_ids)
    sent = spark.sparkContext.broadcast(packed_words(frequent, spell, len(pieces.scores)))
    release()
    cuts, words, word_of = Cuts(pieces.pairs), pieces.words, pieces.word_of
    base = docs.drop("ids")
    columns = list(base.schema)
    row_key, own_words = free_names(base, "row", "own")

    if rare is not None:
        base = base.withColumn(row_key, F.xxhash64("text"))

        def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cut = cuts.start()
            for batch in slices(batches, "text", SLICE):
                rows, missing = [], []
                for key, text in zip(batch.column(row_key).to_pylist(), texts_of(batch), strict=True):
                    parts = sorted({key_of(p) for p in cut([word_of(k) for k in set(words(text))])[0]})
                    gone = [p for p, ids in zip(parts, find_words(sent.value, parts), strict=True) if ids is None]
                    rows += [key] * len(gone)
                    missing += gone
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(missing, pa.string())], names=[row_key, "word"])

        needed = base.select(row_key, "text").mapInArrow(unknown, f"`{row_key}` bigint, word string").distinct()
        extra = needed.join(rare, "word").groupBy(row_key).agg(F.collect_list(F.struct("word", "path")).alias(own_words))
        base = base.join(extra, row_key, "left").drop(row_key)
    all_frequent = rare is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        cut = cuts.start()

        def learn(new: list[bytes], extra: dict[str, bytes]) -> dict[bytes, bytes]:
            """Ids of new keys become known, but for what only this text's own words give: that is returned."""
            own: dict[bytes, bytes] = {}
            parts, ends = cut([word_of(k) for k in new])
            parts = [p if len(p) <= MOST_CHARS else key_of(p) for p in parts]
            flat = find_words(sent.value, parts)
            for key, a, b in zip(new, [0, *ends], ends):
                ids = flat[a:b]
                lost = None in ids
                into = own if lost or len(key) > 1 << 10 else known
                into[key] = b"".join([i if i is not None else extra[p] for i, p in zip(ids, parts[a:b], strict=True)]) if lost else ids[0] if b - a == 1 else b"".join(ids)
            return own

        for batch in slices(batches, "text", SLICE):
            extras = [None] * batch.num_rows if all_frequent else batch.column(own_words).to_pylist()
            keys = [words(t) for t in texts_of(batch)]
            data = []
            own = learn(list(set().union(*keys).difference(known)), {}) if all_frequent else {}
            known.update(own)
            for found, more in zip(keys, extras, strict=True):
                ids = known
                if not all_frequent:
                    extra = {e["word"]: np.array(spell(e["path"]), np.int32).tobytes() for e in more or ()}
                    alone = learn([k for k in set(found) if k not in known], extra)
                    ids = known if not alone else {k: alone[k] if k in alone else known[k] for k in set(found)}
                data.append(b"".join(map(ids.__getitem__, found)))
            for key in own:
                del known[key]
            if len(known) > KNOWN:  # those of the last texts are the likeliest to come again
                known = {k: known[k] for k in set().union(*keys) if k in known}
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(d) // 4 for d in data])]).astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(data), np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in columns), ids], names=[*(f.name for f in columns), "ids"])
        known.clear()
        batch = keys = data = own = offsets = ids = extras = cut = None
        release()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), "ids array<int>"])
    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The rows of `encoded` with a column `decoded` (string) made of `ids`; null ids give null, no ids an empty text.

    The pieces' bytes are joined as hexadecimal digits, in the JVM. Bytes that are no UTF-8 become U+FFFD; that
    does not happen to ids that encode() made.
    """
    digits = constant([b.hex() for b in Pieces(model).bytes_of], "string")
    joined = F.unhex(F.array_join(F.transform("ids", lambda i: F.get(digits, i)), ""))
    text = F.make_valid_utf8(joined.cast("string"))
    first = F.when(F.startswith(text, F.lit(" ")), F.substr(text, F.lit(2))).otherwise(text)
    return encoded.drop("decoded").withColumn("decoded", first)
