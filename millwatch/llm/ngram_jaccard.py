"""Jaccard self-join of word shingle sets by a grouped prefix join, as connected components.

Two sets with 100 * |A and B| >= PERCENT * |A or B| share a token among the first n - ceil(PERCENT * n / 100) + 1
of each, in any common order of tokens. The order puts common tokens last: a count sketch of fixed size gives
each token a level, and tokens go by (level, hash). The sketch decides only how much work there is.

1. Documents with equal sets form a class. Classes with the same size and the same prefix form a group.
2. Prefix tokens of at least two groups are found by minimum and maximum; a Bloom filter of them holds
   back all other postings.
3. Hub rounds: per token a few classes are hubs; in each round every class is compared with two hubs of other
   components (the nearest and a random one). Verified links join components, so most of a large group of
   near copies is joined by a number of comparisons in proportion to its size.
4. Tokens whose groups are all of one component are left out before groups are paired. Group pairs that share a token and are
   not of one component already are filtered by size, position of the token and (single members) bitmap, expanded to members, filtered by the members' bitmaps and verified.

Links inside a component are not needed for the components, so none of that is lost. Bitmaps hold the parity of the
tokens per bit: their distance is at most the symmetric difference, so the filter loses nothing. A short bitmap
filters pairs where they arise, a longer one what is left of them. Token and class hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.bloom import Bloom
from millwatch.llm.components import components
from millwatch.llm.shared import packed, small, stored
from millwatch.llm.words import WordHashes, mix, shingle_hashes, signed, texts_of

SHINGLE = 3
PERCENT = 90
COUNTERS = 1 << 22  # 8 MB for each task, 4 MB as levels
SLICES = 16
SHORT, LONG = 4, 16  # longs of the two bitmaps
HUB_ROUNDS = 2
HUBS = 3  # per token
MOST_BROADCAST_ROWS = 1_000_000  # of two longs each
_GROUP = 0x9AF1_0C5E_77D3_2B69


def shingle_set(text: bytes, size: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence if it is shorter; none without words."""
    hashes = memo.of(text.lower().split())
    return np.unique(shingle_hashes(hashes, min(size, len(hashes)))) if len(hashes) else np.empty(0, np.uint64)


def counter_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(42)).astype(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def ordered_prefix(tokens: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The rarest tokens, in the common order: the level and the leading bits of the hash, as one number each."""
    order = (levels[counter_of(tokens)].astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8))
    n = prefix_length(len(tokens), percent)
    return np.sort(np.partition(order, n - 1)[:n])


def parity_bitmap(tokens: np.ndarray) -> np.ndarray:
    """64 * LONG bits as longs; each token flips one."""
    bits = np.bincount((mix(tokens) & np.uint64(64 * LONG - 1)).astype(np.int64), minlength=64 * LONG) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _set_hash(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes())


def measured(rows: DataFrame, id_type: str, shingle: int) -> DataFrame:
    """Per row doc_id, doc, p, n, c (hash of the set, null without words); and per task rows (slice, counters) of token counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, counts, any_row = WordHashes(), np.zeros(COUNTERS, np.uint32), False
        names = ["doc_id", "doc", "p", "n", "c", "slice", "counters"]
        id_kind = pa.int64()
        for batch in batches:
            any_row, id_kind = True, batch.column("doc_id").type
            sets = [shingle_set(t, shingle, memo) for t in texts_of(batch)]
            at = counter_of(np.concatenate([np.empty(0, np.uint64), *sets]))
            counts += np.bincount(at, minlength=COUNTERS).astype(np.uint32)
            c = signed(np.array([_set_hash(s) for s in sets], np.uint64))
            n = np.array([len(s) for s in sets], np.int64)
            nulls = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("doc_id", "doc", "p")), pa.array(n), pa.array(c, mask=n == 0), nulls, pa.nulls(batch.num_rows, pa.binary())], names=names)
        if any_row:
            parts = [part.tobytes() for part in np.split(np.minimum(counts, 0xFFFF).astype(np.uint16), SLICES)]
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays([none.cast(id_kind), none, none, none, none, pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names=names)

    return stored(rows.select("doc_id", "doc", "p", "text").mapInArrow(run, f"doc_id {id_type}, doc bigint, p bigint, n bigint, c bigint, slice int, counters binary"))


def token_levels(counted: DataFrame) -> np.ndarray:
    """The level of each of the COUNTERS: four times the binary logarithm of its count, rounded down."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, part in zip(batch.column("slice").to_pylist(), batch.column("counters").to_pylist(), strict=True):
                sums[s] = sums.get(s, 0) + np.frombuffer(part, np.uint16).astype(np.float64)
        levels = [np.minimum(np.floor(4 * np.log2(x + 1)), 255).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["slice", "levels"])

    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint8)
    for row in counted.where("slice IS NOT NULL").select("slice", "counters").repartition(SLICES, "slice").mapInArrow(add, "slice int, levels binary").toLocalIterator():
        out[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    return out.ravel()


def close(percent: int, x: str, y: str, bits: str = "") -> Column:
    """What two sets must satisfy to be similar, by sizes and (optionally) the bitmap `bits` of columns prefixed x and y."""
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    fits = 100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)
    if not bits:
        return fits
    return fits & (distance(x, y, bits) <= nx + ny - 2 * overlap(percent, x, y))


def overlap(percent: int, x: str, y: str) -> Column:
    """The smallest intersection of similar sets of these sizes."""
    return F.expr(f"({percent} * ({x}n + {y}n) + {99 + percent}) div {100 + percent}")


def distance(x: str, y: str, bits: str) -> Column:
    """Differing bits of two bitmaps, arrays of longs."""
    size = SHORT if bits == "short" else LONG
    return sum((F.bit_count(F.get(x + bits, F.lit(i)).bitwiseXOR(F.get(y + bits, F.lit(i)))) for i in range(size)), F.lit(0))


def prefixed(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, *(F.col(c).alias(prefix + c) for c in df.columns if c not in keep))


class Sets:
    """Token sets of classes, read from the texts of their smallest documents when first needed, and kept."""

    def __init__(self, rows: DataFrame, facts: DataFrame, shingle: int) -> None:
        self.rows, self.shingle = rows, shingle
        self.first = facts.where("c IS NOT NULL").groupBy("c").agg(F.min("doc").alias("doc"))
        self.kept: DataFrame | None = None

    def of(self, classes: DataFrame) -> DataFrame:
        """(c, tokens) of the classes (c), and perhaps of others."""
        missing = classes.join(self.kept.select("c"), "c", "left_anti") if self.kept is not None else classes
        missing = stored(missing.join(self.first, "c").select("doc").distinct())
        count = missing.count()
        if count:
            filled, shingle = Bloom(missing.select(F.col("doc").alias("h")), count), self.shingle

            def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                memo = WordHashes()
                for batch in batches:
                    some = batch.filter(pa.array(filled.has(batch.column("doc").to_numpy().view(np.uint64))))
                    sets = [s for s in (shingle_set(t, shingle, memo) for t in texts_of(some)) if len(s)]
                    c = signed(np.array([_set_hash(s) for s in sets], np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(c), pa.array([signed(s) for s in sets], pa.list_(pa.int64()))], names=["c", "tokens"])

            found = self.rows.select("doc", "text").mapInArrow(read, "c bigint, tokens array<bigint>").dropDuplicates(["c"])
            if self.kept is not None:
                found = found.join(self.kept.select("c"), "c", "left_anti").unionByName(self.kept)
            self.kept = stored(found)
        return self.kept

    def verified(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs (xc, yc) whose sets are similar, as edges (a, b)."""
        pairs = small(pairs.select("xc", "yc").distinct(), MOST_BROADCAST_ROWS)
        if pairs.isEmpty():
            return pairs.select(F.col("xc").alias("a"), F.col("yc").alias("b"))
        sets = self.of(pairs.select(F.explode(F.array("xc", "yc")).alias("c")).distinct())
        x = sets.select(F.col("c").alias("xc"), F.col("tokens").alias("xt"))
        y = sets.select(F.col("c").alias("yc"), F.col("tokens").alias("yt"))
        needed = pairs.select("yc").distinct()
        both = x.join(pairs, "xc").join(y.join(needed, "yc", "left_semi"), "yc").withColumn("common", F.size(F.array_intersect("xt", "yt")))
        union = F.size("xt") + F.size("yt") - F.col("common")
        return stored(both.where(100 * F.col("common") >= percent * union).select(F.col("xc").alias("a"), F.col("yc").alias("b")))


_LAST = 2**63 - 1  # stands for a null id


def link(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, its own included).

    Null and empty texts and texts without words have no shingles and are linked with nothing. A null id
    counts as larger than all others; it is a component's id (null) only where no document has another. Rows of
    one id are documents of their own; repeated rows are copies. An empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    done = _linked(docs, shingle, percent, hub_rounds)
    return done.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("first") < _LAST, F.col("first")).cast(id_type).alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """The rows of `docs` without those that are linked to a smaller one: of each component the row with the
    smallest id stays (of equal ids the one with the smallest text hash). Documents without words all stay."""
    done = stored(_linked(docs, shingle, percent, hub_rounds).select("doc", "p", F.coalesce("root", F.xxhash64("doc", "p")).alias("root"), F.col("root").isNull().alias("empty")))
    first = done.groupBy("root").agg(F.min(F.struct("doc", "p")).alias("kept"), F.count(F.lit(1)).alias("rows"), F.first("empty").alias("empty")).where("rows > 1 AND NOT empty")
    first = stored(first)
    gone = done.join(first.select("root", "kept"), "root").where(~((F.col("doc") == F.col("kept.doc")) & (F.col("p") == F.col("kept.p")))).select("doc", "p").distinct()
    kept = packed(docs).withColumn("doc", F.coalesce("doc_id", F.lit(_LAST)).cast("bigint"))
    kept = kept.join(small(gone, MOST_BROADCAST_ROWS), ["doc", "p"], "left_anti")
    twice = done.where("NOT empty").groupBy("doc", "p").count().where("count > 1").select("doc", "p")
    twice = small(twice.join(gone, ["doc", "p"], "left_anti"), MOST_BROADCAST_ROWS)
    once = kept.join(twice, ["doc", "p"], "left_anti").select("row")
    return once.unionByName(kept.join(twice, ["doc", "p"], "left_semi").dropDuplicates(["doc", "p"]).select("row")).select("row.*")


def _linked(docs: DataFrame, shingle: int, percent: int, hub_rounds: int) -> DataFrame:
    """Per document doc_id, doc, p (hash of the text), n, root (of its component, null without words), first (smallest doc of it)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).cast("bigint").alias("doc"), F.xxhash64(text).alias("p"), text.alias("text"))
    counted = measured(rows, id_type, shingle)
    facts = counted.where("slice IS NULL").select("doc_id", "doc", "p", "n", "c")
    levels = spark.sparkContext.broadcast(token_levels(counted))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            keys, values = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for text in texts_of(batch):
                found = shingle_set(text, shingle, memo)
                if len(found):
                    prefix = ordered_prefix(found, levels.value, percent)
                    group = np.array([xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=len(found))], np.uint64)
                    keys += [prefix, mix(group ^ np.uint64(_GROUP))]
                    values += [np.repeat(group, len(prefix)), np.array([_set_hash(found)], np.uint64)]
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(signed(np.concatenate(values)))], names=["h", "v"])

    shared = rows.select("text").mapInArrow(tokens, "h bigint, v bigint").groupBy("h").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    shared = stored(shared.where("lo < hi").select("h"))
    filled = Bloom(shared, shared.count())

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sets = [s for s in (shingle_set(t, shingle, memo) for t in texts_of(batch)) if len(s)]
            prefixes = [ordered_prefix(s, levels.value, percent) for s in sets]
            groups = np.array([xxhash.xxh3_64_intdigest(p.tobytes(), seed=len(s)) for p, s in zip(prefixes, sets, strict=True)], np.uint64)
            ends = np.cumsum([len(p) for p in prefixes])
            found = filled.has(np.concatenate([np.empty(0, np.uint64), *prefixes]))
            in_group = filled.has(mix(groups ^ np.uint64(_GROUP)))
            out: dict[str, list] = {k: [] for k in ("h", "pos", "g", "c", "n", "long")}
            for i, tokens in enumerate(sets):
                at = np.flatnonzero(found[ends[i] - len(prefixes[i]) : ends[i]])
                if len(at) or in_group[i]:
                    keys, places = prefixes[i][at], at.astype(np.int32)
                    if in_group[i]:
                        keys = np.append(keys, mix(groups[i : i + 1] ^ np.uint64(_GROUP)))
                        places = np.append(places, np.int32(0))
                    out["h"].append(signed(keys))
                    out["pos"].append(places)
                    out["g"].append(groups[i])
                    out["c"].append(_set_hash(tokens))
                    out["n"].append(len(tokens))
                    out["long"].append(parity_bitmap(tokens))
            arrays = [pa.array(out["h"], pa.list_(pa.int64())), pa.array(out["pos"], pa.list_(pa.int32()))]
            arrays += [pa.array(signed(np.array(out[k], np.uint64))) for k in ("g", "c")]
            arrays += [pa.array(out["n"], pa.int64()), pa.array(out["long"], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["h", "pos", "g", "c", "n", "long"])

    fields = "h array<bigint>, pos array<int>, g bigint, c bigint, n bigint, long array<bigint>"
    candidates = stored(rows.select("text").mapInArrow(postings, fields).dropDuplicates(["c"]))
    folded = [F.get("long", F.lit(i)) for i in range(LONG)]
    for i in range(SHORT, LONG):
        folded[i % SHORT] = folded[i % SHORT].bitwiseXOR(folded[i])
    members = candidates.select("c", "g", "n", F.array(*folded[:SHORT]).alias("short"))
    long = candidates.select("c", "n", "long")

    def narrowed(pairs: DataFrame) -> DataFrame:
        """Pairs (xc, yc) that the long bitmap lets pass, with their distance d."""
        few = small(pairs.select("xc", "yc"), MOST_BROADCAST_ROWS)
        wide = prefixed(long, "y", []).join(prefixed(long, "x", []).join(few, "xc"), "yc").where(close(percent, "x", "y", "long"))
        return wide.select("xc", "yc", distance("x", "y", "long").alias("d"))

    posted = candidates.select("g", "c", F.explode(F.arrays_zip("h", "pos")).alias("at")).select("g", "c", "at.h", "at.pos")
    sets = Sets(rows, facts, shingle)
    roots = stored(members.select("c", F.col("c").alias("root")))

    chosen = [F.min(F.struct(F.xxhash64("c", F.lit(i)).alias("o"), "c")).alias(f"hub{i}") for i in range(HUBS)]
    hubs = posted.groupBy("h").agg(*chosen).select("h", F.array_distinct(F.array(*(f"hub{i}.c" for i in range(HUBS)))).alias("hubs"))
    near = posted.join(hubs, "h").select(F.col("c").alias("xc"), F.explode("hubs").alias("yc")).where("xc <> yc").distinct()
    near = near.join(prefixed(members.drop("g"), "x", []), "xc").join(prefixed(members.drop("g"), "y", []), "yc").where(close(percent, "x", "y", "short"))
    near = small(narrowed(near), MOST_BROADCAST_ROWS)
    sets.of(near.select(F.explode(F.array("xc", "yc")).alias("c")).distinct())
    for turn in range(hub_rounds):
        apart = near.join(roots.select(F.col("c").alias("xc"), F.col("root").alias("xr")), "xc").join(roots.select(F.col("c").alias("yc"), F.col("root").alias("yr")), "yc").where("xr <> yr")
        apart = apart.groupBy("xc").agg(F.min(F.struct("d", "yc")).alias("nearest"), F.min(F.struct(F.xxhash64("xc", "yc", F.lit(turn)).alias("d"), "yc")).alias("any"))
        roots = merged(roots, sets.verified(apart.select("xc", F.explode(F.array("nearest.yc", "any.yc")).alias("yc")), percent))

    rooted = stored(members.join(roots, "c"))
    grouped = rooted.groupBy("g").agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("members"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("short").alias("short"))
    at_roots = posted.select("h", "g", "pos").distinct().join(grouped.select("g", "lo", "hi"), "g")
    apart = at_roots.groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("h")
    at_groups = posted.select("h", "g", "pos").join(small(apart, MOST_BROADCAST_ROWS), "h", "left_semi").distinct().join(grouped, "g")
    one = (F.col("xlo") == F.col("xhi")) & (F.col("ylo") == F.col("yhi")) & (F.col("xlo") == F.col("ylo"))
    reach = F.least(F.col("xn") - F.col("xpos"), F.col("yn") - F.col("ypos")) >= overlap(percent, "x", "y")
    alike = (F.col("xmembers") > 1) | (F.col("ymembers") > 1) | close(percent, "x", "y", "short")
    crossing = prefixed(at_groups, "x", ["h"]).join(prefixed(at_groups, "y", ["h"]), "h").where("xg < yg").where(close(percent, "x", "y") & reach & ~one & alike)
    crossing = crossing.select("xg", "yg").distinct().unionByName(grouped.where("members > 1 AND lo < hi").select(F.col("g").alias("xg"), F.col("g").alias("yg")))
    left, right = prefixed(rooted, "x", []), prefixed(rooted, "y", [])
    inner = (F.col("xg") != F.col("yg")) | (F.col("xc") < F.col("yc"))
    expanded = small(crossing, MOST_BROADCAST_ROWS).join(left, "xg").join(right, "yg").where((F.col("xroot") != F.col("yroot")) & inner & close(percent, "x", "y", "short"))
    roots = merged(roots, sets.verified(narrowed(expanded), percent))

    placed = facts.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    smallest = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc").alias("first"))
    return placed.join(smallest, "root", "left").withColumn("first", F.coalesce("first", "doc"))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (c, root) after the links (a, b) between classes."""
    if links.isEmpty():
        return roots
    ends = roots.select(F.col("c").alias("a"), F.col("root").alias("ra")).join(small(links, MOST_BROADCAST_ROWS), "a")
    ends = roots.select(F.col("c").alias("b"), F.col("root").alias("rb")).join(small(ends, MOST_BROADCAST_ROWS), "b")
    moved = small(components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), MOST_BROADCAST_ROWS)
    return stored(roots.join(moved, roots["root"] == moved["node"], "left").select("c", F.coalesce(moved["root"], roots["root"]).alias("root")))
