"""BPE encoding and decoding with word ends, by a lexicon of frequent words.

The model file (tokenizers, JSON) is read where the job is set up: its vocabulary, merges and special strings. A text is
cut at the special strings; what lies between is composed (NFC), lower-cased character by character and split into words;
white space is dropped. All of this can be done run by run of what lies between white space, so a run is split once in a
task however often it occurs. The words of all texts are counted. Those that occur most, at most MOST_WORDS, are merged and
compiled into a minimal acyclic transducer, which Spark sends to every executor as a file and every task maps into its
memory. A word it lacks is merged where it stands: the merge of lowest rank first, of equal ones the leftmost.

The lexicon saves time and decides nothing: any other set of words gives the same ids. Null and empty texts have no ids;
an empty table gives an empty result; repeated rows are encoded each; a word of any length is merged in about linear time
and memory. Other columns pass through whatever their names; a column named `ids` (`decoded`) is replaced.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import tempfile
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.lexicon import Lexicon, compiled
from millwatch.llm.shared import ship, stored
from millwatch.llm.words import slices, texts_of

MODEL = "/opt/tokenizers/word_bpe_49k.json"
MOST_WORDS = 400_000
MOST_BYTES = 64  # of a word in the lexicon
SLICE = 4 << 20  # bytes of texts looked at together
KEEP = 600_000  # runs a task counts or remembers at once; only saves time
SHORT = 48  # symbols up to which a list is searched instead of a heap
_ID, _NONE = 20, 1 << 62  # bits of an id; no merge

# fixed values: how the model's file splits a lower-cased text into words
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
_ASCII_WORD = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")


@cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


@cache
def _bytes_of_letters() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_letters())}


@cache
def _unassigned() -> re.Pattern:
    """Finds a character that has no meaning in this Python's Unicode tables."""
    free = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for c, d in zip(free, [-2, *free]) if c != d + 1]
    ends = [c for c, d in zip(free, [*free[1:], -2]) if c != d - 1]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends)) + "]")


class WordBpe:
    """The tables of a model: small, and what tasks need of them travels with the functions."""

    def __init__(self, model: str) -> None:
        with open(model, encoding="utf-8") as f:
            self.source = f.read()
        data = json.loads(self.source)
        vocabulary, end = data["model"]["vocab"], data["model"]["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [vocabulary[c] for c in letters]
        self.last = [vocabulary[c + end] for c in letters]
        self.merges = {vocabulary[a] << _ID | vocabulary[b]: rank << _ID | vocabulary[a + b] for rank, (a, b) in enumerate(data["model"]["merges"])}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        names = {i: t for t, i in [*vocabulary.items(), *self.special.items()]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self._library = None

    def words(self, text: bytes) -> list[bytes]:
        """The words of a text or of a run of it, UTF-8; a special string is a word that begins with a space."""
        if b"<|" not in text:
            return self._plain_words(text)
        pattern = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        parts = re.split(f"({pattern})".encode(), text)
        return [w for i, part in enumerate(parts) for w in ([b" " + part] if i % 2 else self._plain_words(part))]

    def _plain_words(self, text: bytes) -> list[bytes]:
        if text.isascii():
            return _ASCII_WORD.findall(text.lower())
        letters = text.decode("utf-8", "replace")
        if _unassigned().search(letters):
            return self._words_by_library(letters)
        lower = unicodedata.normalize("NFC", letters).replace("Σ", "σ").lower()  # a final sigma is lower-cased like any other
        return [w.encode() for w in _WORD.findall(lower)]

    def _words_by_library(self, text: str) -> list[bytes]:
        """The words of a text with characters that this Python does not know, while the tokenizers library may."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source)
        of_letter = _bytes_of_letters()
        pieces = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(map(of_letter.__getitem__, letters)) for letters, _ in pieces]

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_library": None}

    def merged(self, word: bytes) -> list[int]:
        """The ids of a word as words() gives it."""
        if word[:1] == b" ":
            return [self.special[word[1:].decode()]]
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        if len(ids) > SHORT:
            return self._merged_by_heap(ids)
        merges = self.merges
        ranks = [merges.get(a << _ID | b, _NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            new = best & ((1 << _ID) - 1)
            ids[i : i + 2] = [new]
            del ranks[i]
            if i:
                ranks[i - 1] = merges.get(ids[i - 1] << _ID | new, _NONE)
            if i < len(ranks):
                ranks[i] = merges.get(new << _ID | ids[i + 1], _NONE)
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        n, merges = len(ids), self.merges
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get(ids[i] << _ID | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:  # one of them went into another merge
                continue
            ids[i], ids[j] = best & ((1 << _ID) - 1), -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (m := merges.get(ids[i] << _ID | ids[k])) is not None:
                    heapq.heappush(heap, (m, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (m := merges.get(ids[h] << _ID | ids[i])) is not None:
                heapq.heappush(heap, (m, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]


def counted_words(docs: DataFrame, bpe: WordBpe) -> DataFrame:
    """(word, n): the distinct words of all texts, as UTF-8, and how often they occur."""
    words = bpe.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: Counter[bytes] = Counter()

        def send() -> pa.RecordBatch:
            counts: dict[bytes, int] = {}
            for run, n in runs.items():
                for word in words(run):
                    counts[word] = counts.get(word, 0) + n
            runs.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in slices(batches, "text", SLICE):
            for text in texts_of(batch):
                runs.update(text.split())
                if len(runs) > KEEP:
                    yield send()
        if runs:
            yield send()

    return docs.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counted: DataFrame, most_words: int) -> DataFrame:
    """At most `most_words` words that occur most, by classes of like counts; those that occur once are no help."""
    grade = F.floor(8 * F.log2("n"))
    wanted = counted.where((F.col("n") > 1) & (F.octet_length("word") <= MOST_BYTES) & (F.substring("word", 1, 1) != F.lit(b" ")))
    total, least = 0, None
    for row in wanted.groupBy(grade.alias("grade")).count().orderBy(F.desc("grade")).collect():  # a few hundred rows at most
        total += row["count"]
        if total > most_words:
            break
        least = row["grade"]
    return wanted.where(grade >= least if least is not None else F.lit(False)).select("word")


def lexicon_file(docs: DataFrame, bpe: WordBpe, most_words: int) -> str:
    """The name under which tasks find the lexicon of the frequent words of `docs`."""
    merged = bpe.merged

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            ids = [merged(w) for w in words]
            columns = b"\n".join(words), np.array(list(map(len, ids)), np.int32).tobytes(), np.array([i for x in ids for i in x], np.int32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["words", "sizes", "ids"])

    frequent = frequent_words(stored(counted_words(docs, bpe)), most_words)
    entries = []
    for block in frequent.mapInArrow(run, "words binary, sizes binary, ids binary").toLocalIterator():
        stops, ids = np.cumsum(np.frombuffer(block["sizes"], np.int32)).tolist(), np.frombuffer(block["ids"], np.int32).tolist()
        entries += [(w, ids[a:b]) for w, a, b in zip(bytes(block["words"]).split(b"\n"), [0, *stops], stops)]
    entries.sort()
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    path = os.path.join(tempfile.mkdtemp(), name)
    np.save(path, compiled(entries))
    docs.sparkSession.sparkContext.addFile(path)  # Spark copies it to each executor, late ones included
    return name


def encode(docs: DataFrame, model: str = MODEL, most_words: int = MOST_WORDS) -> DataFrame:
    """The rows of `docs` with a column `ids` (array<int>) after their own columns."""
    spark = docs.sparkSession
    ship(spark)
    bpe = WordBpe(model)
    name = lexicon_file(docs, bpe, most_words)
    sent = spark.sparkContext.broadcast(bpe)
    base = docs.drop("ids")
    columns = list(base.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lexicon = sent.value, Lexicon(np.load(SparkFiles.get(name), mmap_mode="r"))
        known: dict[bytes, bytes] = {}  # ids of runs as 32-bit numbers
        merged: dict[bytes, bytes] = {}  # of words that the lexicon lacks

        for batch in slices(batches, "text", SLICE):
            runs = [t.split() for t in texts_of(batch)]
            if len(known) > KEEP:
                known.clear()
                merged.clear()
            new = list(set().union(*runs).difference(known))
            words = [bpe.words(x) for x in new]
            wanted = list(set().union(*words).difference(merged))
            found = dict(zip(wanted, lexicon.packed(wanted)))
            for word in [w for w, ids in found.items() if ids is None]:
                del found[word]
                merged[word] = array("i", bpe.merged(word)).tobytes()
            for x, parts in zip(new, words, strict=True):
                known[x] = b"".join([found[w] if w in found else merged[w] for w in parts])
            data = [b"".join(map(known.__getitem__, x)) for x in runs]
            offsets = np.concatenate([[0], np.cumsum([len(d) // 4 for d in data])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(data), np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in columns), ids], names=[*(f.name for f in columns), "ids"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), "ids array<int>"])
    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The rows of `encoded` with a column `decoded`: the tokens of `ids`, special ones too, with one space between; null for null ids.

    The model's file names no decoder, so tokens keep their letters for bytes and their word ends.
    """
    names = F.split(F.lit(" ".join(WordBpe(model).names)), " ")
    return encoded.drop("decoded").withColumn("decoded", F.array_join(F.transform("ids", lambda i: F.get(names, i)), " "))
