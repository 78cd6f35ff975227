"""Quality classifier: a byte-level convolutional network in numpy.

Each byte becomes a learned vector of EMBED numbers. FILTERS filters look at WIDTH bytes every STRIDE bytes. Chunks
of 2 * BLOCK bytes begin every BLOCK bytes, so they overlap and cover the whole document; each filter is
max-pooled over a chunk. The mean and the maximum over all chunks feed a hidden layer and one probability.

The network is trained on a bounded sample of labelled documents (MOST_PER_LABEL of each label, those with the
smallest hash of their id). Every step draws BATCH of them and of each the whole text or, from DRAWN characters on, stretches at
places drawn anew from the whole text; the cuts are made in tasks, so the driver holds STEPS * BATCH of them and no whole long text.
Scoring reads every byte, in tasks, in groups of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.words import slices, texts_of

EMBED, WIDTH, STRIDE, FILTERS, HIDDEN, BLOCK = 6, 8, 4, 24, 16, 128
MOST_PER_LABEL = 1500
DRAWN = 24 * BLOCK  # characters of a text in one step; a multiple of four
STEPS, BATCH, RATE, SEED = 260, 64, 0.005, 5
THRESHOLD = 0.7
GROUP = 1 << 18  # bytes looked at together

Weights = dict[str, np.ndarray]


def fresh(seed: int = SEED) -> Weights:
    r = np.random.default_rng(seed)
    normal = lambda *shape: r.standard_normal(shape).astype(np.float32)
    return {
        "embed": normal(256, EMBED) * 0.5,
        "conv": normal(WIDTH * EMBED, FILTERS) / np.sqrt(WIDTH * EMBED).astype(np.float32),
        "conv_bias": np.zeros(FILTERS, np.float32),
        "hidden": normal(2 * FILTERS, HIDDEN) / np.sqrt(2 * FILTERS).astype(np.float32),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN) / np.sqrt(HIDDEN).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts on a grid of blocks, padded with zeros, with an empty block after each; and where each begins."""
    blocks = [max(2, -(-len(t) // BLOCK)) + 1 for t in texts]
    starts = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
    data = np.zeros(int(starts[-1]) * BLOCK + WIDTH, np.uint8)
    for t, s in zip(texts, starts[:-1].tolist(), strict=True):
        data[s * BLOCK : s * BLOCK + len(t)] = np.frombuffer(t, np.uint8)
    return data, starts


def windows_of(data: np.ndarray, w: Weights) -> np.ndarray:
    """One row per place of the filters."""
    vectors = w["embed"][data].ravel()
    n = (len(data) - WIDTH) // STRIDE
    return np.lib.stride_tricks.as_strided(vectors, (n, WIDTH * EMBED), (STRIDE * EMBED * 4, 4))


def forward(texts: list[bytes], w: Weights) -> dict[str, np.ndarray]:
    data, starts = laid_out(texts)
    places = windows_of(data, w)
    per_block = BLOCK // STRIDE
    response = (places @ w["conv"]).reshape(-1, per_block, FILTERS)
    best = response.argmax(axis=1)
    block = np.take_along_axis(response, best[:, None], 1)[:, 0]
    second = np.vstack([block[1:], np.full((1, FILTERS), -np.inf, np.float32)])
    from_second = second > block
    pooled = np.maximum(np.where(from_second, second, block) + w["conv_bias"], 0)
    firsts, counts = starts[:-1], np.diff(starts) - 2  # the chunks of a text: all pairs of neighbouring blocks
    inside = np.ones(len(block), bool)
    inside[starts[1:] - 1] = inside[starts[1:] - 2] = False
    masked = np.where(inside[:, None], pooled, 0)
    mean = np.add.reduceat(masked, firsts, axis=0) / counts[:, None]
    top = np.maximum.reduceat(masked, firsts, axis=0)
    features = np.hstack([mean, top]).astype(np.float32)
    hidden = np.maximum(features @ w["hidden"] + w["hidden_bias"], 0)
    score = 1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"][0], -30, 30)))
    steps = {"data": data, "starts": starts, "places": places, "best": best, "from_second": from_second, "inside": inside}
    return steps | {"masked": masked, "firsts": firsts, "counts": counts, "top": top, "features": features, "hidden": hidden, "score": score}


def scores(texts: list[bytes], w: Weights) -> np.ndarray:
    """The probability of label 1 for each text."""
    out, group, size = [], [], 0
    for t in texts:
        if len(t) > GROUP:  # one long text: its chunks in pieces
            out.append(("long", t))
        else:
            out.append(("short", len(group)))
            group.append(t)
            size += len(t) + 3 * BLOCK
    done: list[float] = []
    at = 0
    while at < len(group):
        end, size = at, 0
        while end < len(group) and (size == 0 or size + len(group[end]) <= GROUP):
            size += len(group[end]) + 3 * BLOCK
            end += 1
        done.extend(forward(group[at:end], w)["score"].tolist())
        at = end
    return np.array([done[x] if kind == "short" else long_score(x, w) for kind, x in out], np.float64)


def long_score(text: bytes, w: Weights) -> float:
    """The same as forward() for one text, with pieces that share a block so that every chunk is seen once."""
    step = GROUP // BLOCK * BLOCK
    total, top, chunks = 0.0, 0.0, 0
    blocks = -(-len(text) // BLOCK)
    for start in range(0, (blocks - 1) * BLOCK, step):
        piece = text[start : start + step + BLOCK + WIDTH]
        n = min(step // BLOCK + 1, blocks - start // BLOCK)
        data = np.zeros(n * BLOCK + WIDTH, np.uint8)
        use = min(len(piece), len(data))
        data[:use] = np.frombuffer(piece[:use], np.uint8)
        block = (windows_of(data, w) @ w["conv"])[: n * BLOCK // STRIDE].reshape(n, -1, FILTERS).max(axis=1)
        pooled = np.maximum(np.maximum(block[1:], block[:-1]) + w["conv_bias"], 0)
        total, top, chunks = total + pooled.sum(axis=0, dtype=np.float64), np.maximum(top, pooled.max(axis=0)), chunks + len(pooled)
    features = np.concatenate([total / chunks, top]).astype(np.float32)
    hidden = np.maximum(features @ w["hidden"] + w["hidden_bias"], 0)
    return float(1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"][0], -30, 30))))


def gradients(texts: list[bytes], y: np.ndarray, w: Weights) -> tuple[Weights, float]:
    """Of the mean cross entropy, and that."""
    f = forward(texts, w)
    p, n = f["score"], len(texts)
    g: Weights = {k: np.zeros_like(v) for k, v in w.items()}
    d_out = ((p - y) / n).astype(np.float32)
    g["out"], g["out_bias"][0] = f["hidden"].T @ d_out, d_out.sum()
    d_hidden = np.outer(d_out, w["out"]) * (f["hidden"] > 0)
    g["hidden"], g["hidden_bias"] = f["features"].T @ d_hidden, d_hidden.sum(axis=0)
    d_features = d_hidden @ w["hidden"].T
    owner = np.repeat(np.arange(n), np.diff(f["starts"]))
    masked = f["masked"]
    d_pooled = d_features[owner, :FILTERS] / f["counts"][owner][:, None]
    is_top = (masked == f["top"][owner]) & (masked > 0)
    tied = np.add.reduceat(is_top, f["firsts"], axis=0)
    d_pooled = d_pooled + np.where(is_top, d_features[owner, FILTERS:] / np.maximum(tied, 1)[owner], 0)
    d_pooled *= f["inside"][:, None] & (masked > 0)
    g["conv_bias"] = d_pooled.sum(axis=0).astype(np.float32)
    block = np.arange(len(masked))[:, None] + f["from_second"]
    block = np.minimum(block, len(masked) - 1)
    place = (block * (BLOCK // STRIDE) + f["best"][block, np.arange(FILTERS)]).astype(np.int64)
    seen = f["places"][place.ravel()].reshape(*place.shape, -1)
    g["conv"] = np.einsum("bf,bfk->kf", d_pooled, seen).astype(np.float32)
    d_seen = (d_pooled[..., None] * w["conv"].T[None]).reshape(-1, WIDTH, EMBED)
    used = np.abs(d_pooled).ravel() > 0
    bytes_at = (place.ravel()[used] * STRIDE)[:, None] + np.arange(WIDTH)
    np.add.at(g["embed"], f["data"][bytes_at].ravel(), d_seen[used].reshape(-1, EMBED))
    return g, float(-np.mean(np.log(np.where(y > 0, p, 1 - p) + 1e-9)))


def drawn(labels: list[int], steps: int = STEPS, seed: int = SEED) -> list[np.ndarray]:
    """The texts of every step, by their places in `labels`: as many of either label."""
    r = np.random.default_rng(seed)
    kinds = [k for k in (np.flatnonzero(np.array(labels) == kind) for kind in (0, 1)) if len(k)]
    return [np.concatenate([r.choice(k, BATCH // len(kinds)) for k in kinds]) for _ in range(steps)] if kinds else []


def train(batches: list[tuple[list[bytes], np.ndarray]], seed: int = SEED) -> Weights:
    """Adam, one step for each batch of texts and labels; without batches the network as it begins."""
    w = fresh(seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for t, (texts, y) in enumerate(batches, 1):
        g, _ = gradients(texts, y.astype(np.float32), w)
        rate = RATE * min(1.0, t / 20, 3 * (1 - t / (len(batches) + 1)))
        for k in w:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
            w[k] = (w[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)
    return w


def drawn_texts(docs: DataFrame, ids: list, picks: list[np.ndarray]) -> list[list[bytes]]:
    """The texts of every step, as pieces(): at most STEPS * BATCH of them, cut in tasks. Of repeated ids the smallest cut counts."""
    spark, places = docs.sparkSession, np.concatenate(picks)
    of_id: dict[int, list[int]] = {}
    for draw, place in enumerate(places.tolist()):
        of_id.setdefault(place, []).append(draw)
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = spark.createDataFrame([(ids[place], draws) for place, draws in of_id.items()], f"doc_id {kind}, draws array<int>")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", text).join(F.broadcast(wanted), "doc_id").select("text", F.explode("draws").alias("draw"))
    cut = {r["draw"]: r["cut"].encode() for r in rows.select("draw", pieces("text", "draw").alias("cut")).groupBy("draw").agg(F.min("cut").alias("cut")).collect()}
    ends = np.cumsum([0, *map(len, picks)]).tolist()
    return [[cut[d] for d in range(a, b)] for a, b in zip(ends, ends[1:], strict=False)]


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Learns from rows whose crc32 of the id, as text, modulo 4 is not 2. Null texts count as empty; empty texts get
    the score of an empty text. A row with a null id is never learned from and not held out. Null labels are
    ignored; a document labelled twice counts with its smallest label. Without labels of both kinds the
    score is that of an untrained network. Repeated rows are scored each; an empty table gives an empty result.
    """
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = marks.where(part != 2)
    ids = [marks.where((F.col("quality") == 1) if k else (F.col("quality") != 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_PER_LABEL) for k in (0, 1)]
    chosen = F.broadcast(ids[0].unionByName(ids[1]))  # 2 * MOST_PER_LABEL rows at most
    rows = docs.select("doc_id").join(chosen, "doc_id").select("doc_id", "quality").distinct().orderBy("doc_id").collect()
    y = np.array([int(r["quality"] == 1) for r in rows])
    picks = drawn(y.tolist(), STEPS)
    texts = drawn_texts(docs, [r["doc_id"] for r in rows], picks) if picks else []
    trained = train([(t, y[p]) for t, p in zip(texts, picks, strict=True)])
    totals = marks.agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad")).first()
    if totals["good"] and totals["bad"]:  # trained on equal shares, used on these
        trained["out_bias"] += np.float32(np.log(totals["good"] / totals["bad"]))
    sent = docs.sparkSession.sparkContext.broadcast(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(texts_of(batch), sent.value))], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def pieces(text: str, draw: str):
    """What one draw of a text trains on: the whole if it has at most DRAWN characters, else a stretch that begins at a random place of each quarter.

    A stretch that meets the end goes on at the beginning, so every character is as likely to be met. The places depend on the text's
    length and the draw: each draw of a text is another cut.
    """
    c, n, part = F.col(text), F.length(text), DRAWN // 4

    def stretch(i: int):
        first = F.floor(n * i / 4)
        start = first + F.pmod(F.xxhash64(draw, F.lit(i)), F.floor(n * (i + 1) / 4) - first) + 1
        beyond = F.greatest(start + part - 1 - n, F.lit(0))
        return F.concat(F.substr(c, start.cast("int"), F.lit(part)), F.substr(c, F.lit(1), beyond.cast("int")))

    return F.when(n <= DRAWN, c).otherwise(F.concat(*map(stretch, range(4))))
