"""Quality rules and the quality classifier."""

import math
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from millwatch.llm import quality_classifier as Q
from millwatch.llm import quality_rules as R


def counts_by_hand(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if regex.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(regex.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), len(lines), len(regex.findall(r"\p{Lu}", text)),
    )


@pytest.mark.parametrize("text", ["", " \n\t", "a", "a b c", "a b c a b c", "a a a a a", "x\nx\n\n x\nÉa | <b> 𝔸\x0bz", "ß\x1cA\xa0B c\r\nd"])
def test_counts(text):
    assert R.count_text(text.encode()) == counts_by_hand(text)


def test_counts_of_random_texts():
    r = random.Random(2)
    for _ in range(60):
        text = "".join(r.choices("ab É#\n \t", k=r.randrange(200)))
        assert R.count_text(text.encode()) == counts_by_hand(text)


def test_binomial_tail():
    for n, p in [(1, 0.5), (40, 0.03), (300, 0.2)]:
        tail = R.binomial_tail(n, p)
        exact = np.cumsum([math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(len(tail))])
        assert np.allclose(tail, np.minimum(exact, 1))
    large = R.binomial_tail(10**7, 0.03)
    assert 0.49 < large[300_000] < 0.51


def test_all_rules_together_keep_their_promise():
    """All rules together reject clean texts within the limit, on a second draw, in nearly all trials."""
    r = np.random.default_rng(4)
    draw = lambda n: r.geometric([0.03, 0.05, 0.1], (n, 3)).clip(max=255)
    broken = used = 0
    for _ in range(200):
        first, junk = draw(300), r.integers(20, 255, (300, 3))
        cuts = [R.proposed(np.bincount(first[:, k], minlength=R.GRID), np.bincount(junk[:, k], minlength=R.GRID)) for k in range(3)]
        cuts = np.array([R.GRID if c is None else c for c in cuts])
        margins = (draw(1000) - cuts).max(axis=1)
        raised = R.certified(np.bincount(margins[margins >= 0], minlength=R.GRID), 1000, 0.03, 0.05)
        if raised is not None:
            used += 1
            broken += ((draw(20_000) - cuts).max(axis=1) >= raised).mean() > 0.03
    assert used > 150 and broken <= 20


def test_proposals_and_certificates():
    clean, junk = np.zeros(R.GRID, int), np.zeros(R.GRID, int)
    assert R.proposed(clean, junk) is None
    clean[3], junk[200], junk[2] = 50, 100, 1
    assert R.proposed(clean, junk) == 200
    junk[210] = 100
    assert R.proposed(clean, junk) == 200
    clean[205] = 10  # as good as 200 now, and more lenient
    assert R.proposed(clean, junk) == 210
    margins = np.zeros(R.GRID, int)
    assert R.certified(margins, 50, 0.03, 0.0025) is None and R.certified(margins, 0, 0.03, 0.5) is None
    assert R.certified(margins, 1000, 0.03, 0.0025) == 0
    margins[7] = 100
    assert R.certified(margins, 1000, 0.03, 0.0025) == 8


def prose(r, n):
    return " ".join("".join(r.choices("abcdefg", k=r.randrange(2, 8))) for _ in range(n)) + "."


def labelled(spark, documents, n=900):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = prose(r, r.randrange(60, 120))
        rows.append((i, text.replace(" ", " ### ") if bad else text, "en" if i % 2 else None))
        if i % 10:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(n, None, "en"), (n + 1, "", "en"), (n + 2, "too short", "en"), (n + 3, rows[1][1].replace(" ", " ### "), "xx"), (5, rows[5][1], "en")]
    labels += [(None, 1, 0), (4, None, 0), (1, 1, 0), (1, 0, 0)]
    return documents(*rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_rules_reject_junk_in_certified_strata_only(spark, documents, clashing):
    docs, labels = labelled(spark, documents)
    got = {}
    for row in R.judge(clashing(docs), labels).collect():
        got[row["doc_id"]] = row
    assert R.judge(docs, labels).columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert not got[900]["kept"] and got[900]["base_failed"] and got[901]["base_failed"] and got[902]["base_failed"]
    assert got[903]["kept"]  # junk, but of a stratum without labels
    assert all(not got[i]["kept"] for i in range(900) if i % 3 == 0)
    assert sum(got[i]["kept"] for i in range(900) if i % 3) > 0.95 * 600
    kept = R.kept_rows(clashing(docs), labels)
    assert kept.columns == clashing(docs).columns
    assert kept.count() == sum(r["kept"] for r in R.judge(docs, labels).collect())


def test_rules_on_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert R.judge(documents(), none).isEmpty()
    assert R.judge(documents((1, "a " * 3)), none).first()["kept"] is False


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in Q.fresh(3).items()}
    texts = [bytes(r.integers(32, 120, n).astype(np.uint8)) for n in (5, 300, 700)]
    y = np.array([0, 1, 1.0])
    w32 = {k: v.astype(np.float32) for k, v in w.items()}
    g, loss = Q.gradients(texts, y, w32)
    for name, at in [("out", 3), ("hidden_bias", 2), ("conv_bias", 5), ("out_bias", 0)]:
        moved = {k: v.copy() for k, v in w32.items()}
        moved[name][at] += 1e-2
        assert (Q.gradients(texts, y, moved)[1] - loss) / 1e-2 == pytest.approx(g[name][at], abs=3e-3)


def test_long_texts_score_like_whole_ones(monkeypatch):
    w = Q.fresh(2)
    text = bytes(np.random.default_rng(0).integers(32, 120, 10_000).astype(np.uint8))
    whole = Q.scores([text, b"", b"x"], w)
    monkeypatch.setattr(Q, "GROUP", 1024)
    assert Q.scores([text, b"", b"x"], w) == pytest.approx(whole, abs=1e-5)


def plain_score(text, w):
    """The network by loops over single numbers."""
    blocks = max(2, -(-len(text) // Q.BLOCK))
    data = text + bytes(blocks * Q.BLOCK + Q.WIDTH - len(text))
    chunks = []
    for chunk in range(blocks - 1):
        pooled = []
        for f in range(Q.FILTERS):
            best = -math.inf
            for start in range(chunk * Q.BLOCK, (chunk + 2) * Q.BLOCK, Q.STRIDE):
                total = 0.0
                for i in range(Q.WIDTH):
                    for e in range(Q.EMBED):
                        total += float(w["embed"][data[start + i]][e]) * float(w["conv"][i * Q.EMBED + e][f])
                best = max(best, total)
            pooled.append(max(0.0, best + float(w["conv_bias"][f])))
        chunks.append(pooled)
    features = [sum(c[f] for c in chunks) / len(chunks) for f in range(Q.FILTERS)] + [max(c[f] for c in chunks) for f in range(Q.FILTERS)]
    out = float(w["out_bias"][0])
    for k in range(Q.HIDDEN):
        total = float(w["hidden_bias"][k]) + sum(x * float(w["hidden"][j][k]) for j, x in enumerate(features))
        out += max(0.0, total) * float(w["out"][k])
    return 1 / (1 + math.exp(-out))


def test_scores_are_those_of_plain_loops(monkeypatch):
    w = Q.fresh(4)
    r = np.random.default_rng(2)
    w["conv_bias"] += r.normal(size=Q.FILTERS).astype(np.float32) * 0.3
    w["hidden_bias"] += 0.1
    texts = [b"", b"a", "ü€ text".encode(), *(bytes(r.integers(0, 256, n).astype(np.uint8)) for n in (127, 128, 129, 256, 257, 500))]
    want = [plain_score(t, w) for t in texts]
    assert Q.scores(texts, w) == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(Q, "GROUP", 256)  # the way of very long texts
    assert Q.scores(texts, w) == pytest.approx(want, abs=1e-5)


def test_draws_reach_every_part_of_a_long_text(spark):
    n = 5 * Q.DRAWN + 3
    text = "".join(chr(0x4E00 + i) for i in range(n))
    cuts = [r[0] for r in spark.range(400).select(F.lit(text).alias("text"), F.col("id").cast("int").alias("draw")).select(Q.pieces("text", "draw")).collect()]
    assert {len(c) for c in cuts} == {Q.DRAWN} and len(set(cuts)) == 400
    seen = set().union(*cuts)
    assert seen == set(text)  # the ends of the text and of its quarters too
    short = spark.createDataFrame([("x" * Q.DRAWN, 1), ("", 2)], "text string, draw int").select(Q.pieces("text", "draw").alias("t"))
    assert sorted(len(r["t"]) for r in short.collect()) == [0, Q.DRAWN]


def test_texts_of_each_step(spark, documents):
    docs = documents((1, "one"), (2, None), (3, "b"), (3, "a"), (None, "none"))
    got = Q.drawn_texts(docs, [1, 2, 3], [np.array([0, 2]), np.array([1, 0])])
    assert got == [[b"one", b"a"], [b"", b"one"]]
    assert Q.drawn([], 3) == [] and [len(p) for p in Q.drawn([1, 1], 2)] == [Q.BATCH] * 2


def test_classifier_learns(spark, documents, clashing, monkeypatch):
    monkeypatch.setattr(Q, "STEPS", 80)
    docs, labels = labelled(spark, documents)
    rows = {r["doc_id"]: r for r in Q.classify(clashing(docs), labels).collect()}
    held = [r for i, r in rows.items() if i is not None and i < 900 and r["held_out"]]
    assert 150 < len(held) < 300
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in held) > 0.95 * len(held)
    assert 0 <= rows[900]["score"] <= 1 and rows[900]["score"] == pytest.approx(rows[901]["score"])
    assert Q.classify(documents(), labels).isEmpty()
