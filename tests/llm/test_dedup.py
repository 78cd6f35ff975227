"""Substring dedup, suffix dedup and the similarity join against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millwatch.llm import ngram_jaccard, substring_dedup, suffix_dedup, suffix_runs
from millwatch.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def corpus(seed, n=60):
    """Random texts with copies, near copies, shared passages, repeats inside a text and odd rows."""
    r = random.Random(seed)
    passage = " ".join(r.choices(WORDS, k=70))
    rows = []
    for i in range(n):
        kind = r.random()
        text = " ".join(r.choices(WORDS, k=r.choice([3, 20, 60, 150])))
        if kind < 0.25 and rows:
            text = r.choice(rows)[1] or ""
            if r.random() < 0.6 and text:
                words = text.split(" ")
                words[r.randrange(len(words))] = "changed"
                text = " ".join(words)
        elif kind < 0.5:
            cut = passage.split(" ")[r.randrange(15) : r.randrange(55, 70)]
            text = f"{text} {' '.join(cut)} {text[:40]}é"
        elif kind < 0.6:
            text = "again " * r.choice([10, 120])
        rows.append((i, text))
    return [*rows, (900, None), (901, ""), (902, " \n\t"), (5, rows[5][1]), (None, rows[7][1]), (None, passage)]


def removed_words(rows, window):
    first = {}
    for doc, text in rows:
        words = (text or "").split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, np.inf), np.inf if doc is None else doc)
    out = []
    for doc, text in rows:
        words, gone = (text or "").split(), set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (np.inf if doc is None else doc):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("window", "period"), [(50, 31), (12, 7), (5, 5)])
def test_substring_dedup_equals_brute_force(documents, clashing, window, period):
    rows = corpus(window)
    got = substring_dedup.remove_repeats(clashing(documents(*rows)), window, period).collect()
    assert Counter((r[0], r[1], r[2], r[3]) for r in got) == Counter(removed_words(rows, window))


@pytest.mark.parametrize("period", [1, 2, 7, 13, 31, 48])
def test_difference_cover_has_every_difference(period):
    cover = substring_dedup.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def removed_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize(("run", "batch", "part"), [(40_000, 16_384, 40_000), (50, 16, 60)])
@pytest.mark.parametrize("length", [200, 30])
def test_suffix_dedup_equals_brute_force(documents, clashing, monkeypatch, length, run, batch, part):
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    rows = corpus(length + run)
    got = suffix_dedup.remove_repeats(clashing(documents(*rows)), length).collect()
    assert Counter(tuple(r[i] for i in range(5)) for r in got) == Counter(removed_bytes(rows, length))


def test_a_repeat_inside_one_text_longer_than_a_segment(documents):
    r = random.Random(4)
    some = ["".join(r.choices("abcdefgh ", k=k)) for k in (1000, suffix_dedup.SEGMENT + 50_000, 1000, 300)]
    text = f"{some[0]}1{some[3]}2{some[1]}3{some[3]}4{some[2]}"
    row = suffix_dedup.remove_repeats(documents((1, text), (2, some[0][::-1]))).where("doc_id = 1").first()
    assert (row["n_removed"], row["n_spans"]) == (600, 2)
    assert row["kept_text"] == f"{some[0]}12{some[1]}34{some[2]}"


def test_a_passage_of_many_texts_is_sent_once_in_a_run(documents):
    hot = [(b"k" * 300, 200, p, at) for p in range(500) for at in (7, 7)]
    assert suffix_dedup.representatives([*hot, (b"a" * 300, 200, 1, 9), (b"a" * 300, 200, 1, 9)]) == ([b"a" * 300, b"k" * 300], [200, 200], [1, 2])
    r = random.Random(7)
    passage = " ".join(r.choices(WORDS, k=150))
    rows = [(i, f"{' '.join(r.choices(WORDS, k=60))} {passage} {' '.join(r.choices(WORDS, k=60))}") for i in range(120)]
    got = suffix_dedup.remove_repeats(documents(*rows)).collect()
    assert Counter(tuple(x[i] for i in range(5)) for x in got) == Counter(removed_bytes(rows, 200))


def test_segments_of_a_text_give_the_places_of_the_whole(documents):
    r = random.Random(5)
    texts = [bytes(r.choices(b"abcd", k=k)) for k in (10, 5000, 30, 299, 4000)]
    whole, cut = list(suffix_dedup.sampled(texts, 30, 15)), list(suffix_dedup.sampled(texts, 30, 15, 100))
    assert [n for n, _, _ in cut] == [n for n, _, _ in whole] == [1, 2, 3, 4]
    for (_, at, h), (_, other, k) in zip(whole, cut, strict=True):
        assert np.array_equal(at, other) and np.array_equal(h, k)


def test_suffix_dedup_keeps_whole_characters_in_texts(documents, clashing):
    body = "é" * 150
    docs = clashing(documents((1, "a" + body + "ü"), (2, "ü" + body + "b"), (3, "alone"), (4, "")))
    kept = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(docs).collect()}
    assert kept == {1: "a", 2: "üb", 3: "alone", 4: ""}  # é and ü share their first byte, so that of the last ü goes too
    assert suffix_dedup.without_repeats(docs).columns == docs.columns


def test_loser_tree_merges_and_knows_common_prefixes():
    r = random.Random(3)
    runs = [sorted(bytes(r.choices(b"ab", k=r.randrange(1, 9))) for _ in range(r.randrange(0, 40))) for _ in range(7)]
    merged = list(suffix_runs.merged([suffix_runs.decoded(*suffix_runs.front_coded(x, 10)) if x else iter(()) for x in runs]))
    keys = [k for _, k, _ in merged]
    assert keys == sorted(k for x in runs for k in x)
    for (_, a, _), (shared, b, _) in zip(merged, merged[1:], strict=False):
        assert a[:shared] == b[:shared] and (a[shared : shared + 1] != b[shared : shared + 1] or shared == min(len(a), len(b)))
    assert list(suffix_runs.merged([])) == []


def linked(rows, size, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if find(k) == find(i) and d is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_similarity_components_equal_brute_force(documents, clashing, size, percent):
    rows = corpus(size * percent, 80)
    got = ngram_jaccard.link(clashing(documents(*rows)), size, percent).collect()
    assert Counter(map(tuple, got)) == Counter(linked(rows, size, percent))


def test_a_large_group_of_near_copies(documents):
    r = random.Random(1)
    base = r.choices(WORDS, k=120)
    rows = []
    for i in range(150):
        words = list(base)
        words[r.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = ngram_jaccard.link(documents(*rows)).collect()
    assert Counter(map(tuple, got)) == Counter(linked(rows, 3, 90))


def test_one_of_each_component_stays(documents, clashing):
    text = " ".join(WORDS[:100])
    docs = clashing(documents((3, text), (1, text + " end"), (2, "other words here"), (7, ""), (8, ""), (1, text + " end"), (None, text)))
    kept = ngram_jaccard.one_of_each(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 7, 8]
    assert kept.columns == docs.columns


@pytest.mark.parametrize("few", [0, 1000])
def test_components(spark, few):
    edges = [(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (4, 4), *((100 + i, 101 + i) for i in range(40))]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), few).collect()}
    assert got == {2: 1, 3: 1, 9: 1, 6: 5, **{101 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), few).isEmpty()


@pytest.mark.parametrize("operator", [substring_dedup.remove_repeats, suffix_dedup.remove_repeats, ngram_jaccard.link])
def test_empty_tables(documents, operator):
    assert operator(documents()).isEmpty()
