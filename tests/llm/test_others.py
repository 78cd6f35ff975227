"""Sharding, URL filter, HTML extraction, decontamination, pieces, Bloom filters."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millwatch.llm import decontamination, html_extraction, sentencepiece_lattice, shared, sharding, url_filter
from millwatch.llm.bloom import Bloom
from millwatch.llm.html_blocks import blocks

# --- sharding ---------------------------------------------------------------------------------------


def packed_by_hand(sizes, capacity):
    """Best fit decreasing, one group at a time."""
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fitting:
            room, i = min(fitting)
            rooms[i] = room - size
        else:
            rooms.append(max(capacity, size) - size)
    return sorted(rooms)


def test_packing_equals_best_fit_decreasing():
    r = random.Random(8)
    for _ in range(40):
        sizes = [r.choice([1, 2, 3, 7, 20, 33, 50, 120]) for _ in range(r.randrange(1, 80))]
        classes = sorted(Counter(sizes).items(), reverse=True)
        used = defaultdict(int)
        for size, _, n, at in sharding.pack(classes, 100):
            used[at] += size * n
        largest = {at: max(100, used[at]) - used[at] for at in used}
        assert sorted(largest.values()) == packed_by_hand(sizes, 100)


def test_shards(documents, clashing):
    r = random.Random(9)
    rows = [(i, "x" * r.randrange(400) + str(i % 90)) for i in range(500)] + [(900, None), (901, ""), (7, "again"), (7, "again"), (None, "no id")]
    got = sharding.shard(clashing(documents(*rows)), shards=4).collect()
    assert len(got) == len(rows)
    loads, slots, home = Counter(), defaultdict(list), defaultdict(set)
    for x in got:
        loads[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
        home[x["size"], x["text_crc32"]].add(x["shard"])
    assert set(loads) == {0, 1, 2, 3} and max(loads.values()) - min(loads.values()) < 100
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())
    assert {x["text_crc32"] for x in got if x["doc_id"] == 7} >= {zlib.crc32(b"again")}
    assert sharding.shard(documents()).isEmpty()


def test_fixed_capacity(documents):
    got = sharding.shard(documents(*[(i, "x" * 59 + str(i % 10)) for i in range(10)], (99, "y" * 500)), capacity=200).collect()
    assert len({x["shard"] for x in got}) == 5  # three groups of 61 bytes to a bin, and one bin for the large group


def test_ranks_of_a_frequent_key(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 7)
    df = spark.range(100).select((F.col("id") % 3 == 0).alias("k"), "id")
    got = sharding.numbered(df, ["k"], [F.col("id")], "rank").groupBy("k").agg(F.sort_array(F.collect_list("rank")).alias("r")).collect()
    assert all(r["r"] == list(range(len(r["r"]))) for r in got)


# --- urls -------------------------------------------------------------------------------------------


def test_urls(spark):
    cases = {
        "http://WWW.Example.ORG/en/5?x#y": ("www.example.org", "/en/5", "org/", "allow"),
        "https://example.org/es/": ("example.org", "/es/", "example.org/es/", "block"),
        "https://a.example.org/en/12": ("a.example.org", "/en/12", "example.org/en/1", "block"),
        "https://notexample.com/fr/x://y": ("notexample.com", "/fr/x://y", "com/fr/", "allow"),
        "ftp://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "http://org?x": ("org", "", None, None),
        "http://org/": ("org", "/", "org/", "allow"),
        "no scheme.org/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "http://casino-win.example.net/en/1": ("casino-win.example.net", "/en/1", None, "block"),
        "http://thther.example.net/en/1": ("thther.example.net", "/en/1", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)], "page_id bigint, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] in ({verdict} if verdict else {"allow", "block"})
    assert url_filter.judge(pages.limit(0)).isEmpty()


def features(url):
    rest = url.split("://", 1)[1]
    host = rest.split("/")[0]
    text = f"^{host}${rest[len(host):]}"
    n = [sum(ord(text[i + k]) * 31**k for k in range(3)) % url_filter.BUCKETS for i in range(len(text) - 2)]
    return np.bincount(n, minlength=url_filter.BUCKETS) / np.sqrt(len(n))


def test_training_is_gradient_descent(spark):
    x = np.array([[*features(u), 1.0] for u, _ in url_filter.LABELLED])
    y = np.array([v for _, v in url_filter.LABELLED])
    w = np.zeros(url_filter.BUCKETS + 1)
    for _ in range(url_filter.EPOCHS):
        w = w * (1 - url_filter.RATE * url_filter.DECAY) + url_filter.RATE * 10 * x.T @ (y - 1 / (1 + np.exp(-x @ w))) / len(y)
    assert np.allclose(url_filter.train(spark), w)
    assert (((x @ w) > 0) == (y == 1)).all()


# --- html -------------------------------------------------------------------------------------------


def test_blocks():
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <nav><a href='x>y'>Menu</a></nav><!-- <p>no</p> --><article class="Post main"><h1>A&amp;B</h1>
      <p>one <b>two</b>&nbsp;<br>three<p>four</p><ul><li>five<li>six</ul><pre> a   b </pre></article>
      <footer>&copy; f</footer>"""
    got = [(b.text, b.path[-1]) for b in blocks(page)]
    assert got == [
        ("Menu", "nav"), ("A&B", "h1"), ("one two three", "p"), ("four", "p"), ("five", "li"), ("six", "li"),
        ("a b", "pre"), ("© f", "footer"),
    ]
    assert "article.post" in blocks(page)[1].path
    assert blocks("") == [] and blocks("<p") == [] and [b.text for b in blocks("a < b")] == ["a < b"]
    assert [b.text for b in blocks("<script>never closed <p>x")] == []


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<datalist><option value=a><option value=b></datalist><article><p>Main text.</p></article>", ["Main text."]),
        ("<select><option>a<option>b<p>Main</p>", ["Main"]),
        ("<option>a<p>Main", ["Main"]),
        ("<p>one <svg><title>t</title><text>no</text></svg> two</p>", ["one two"]),
        ("<p>a <select><option>1</option></select> b</p>", ["a b"]),
        ("<nav><noscript>x</nav><p>Main</p><noscript><div>y</div></noscript><p>z</p>", ["x", "Main", "z"]),
        ("<div><svg><g>x</div><p>Main</p></svg>", ["Main"]),
        ("<template><div><p>no</p></div></template><p>yes</p>", ["yes"]),
        ("<template><p>Main", ["Main"]),
        ("<svg/><p>Main</p></noscript>", ["Main"]),
    ],
)
def test_elements_that_show_nothing_hide_no_more_than_themselves(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_lstm_equals_plain_loops():
    r = np.random.default_rng(8)
    w = {k: v + r.normal(0, 0.1, v.shape).astype(np.float32) for k, v in html_extraction.fresh(2).items()}
    lengths = [5, 3]
    pages = [r.random((n, html_extraction.INPUT)).astype(np.float32) for n in lengths]
    got, _ = html_extraction.probabilities(*html_extraction.padded(pages), w)
    size = html_extraction.STATE
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for k, page in enumerate(pages):
        both = {}
        for way in "fb":
            h, c = [0.0] * size, [0.0] * size
            for t in range(len(page)) if way == "f" else range(len(page) - 1, -1, -1):
                z = [float(w[f"{way}c"][j]) + sum(float(x) * float(v) for x, v in zip(page[t], w[f"{way}x"][:, j], strict=True)) + sum(h[i] * float(w[f"{way}h"][i, j]) for i in range(size)) for j in range(4 * size)]
                c = [sigmoid(z[size + j]) * c[j] + sigmoid(z[j]) * math.tanh(z[3 * size + j]) for j in range(size)]
                h = [sigmoid(z[2 * size + j]) * math.tanh(c[j]) for j in range(size)]
                both[way, t] = h
        for t in range(len(page)):
            z = float(w["bias"][0]) + sum(float(a) * b for a, b in zip(w["out"], both["f", t] + both["b", t], strict=True)) + sum(float(x) * float(v) for x, v in zip(page[t], w["skip"], strict=True))
            assert got[t, k] == pytest.approx(sigmoid(z), abs=1e-4)


# pages that no template made: (html, blocks of main text, other blocks)
HAND = [
    ("""<body><div id=hdr><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a></div>
      <div class=story><h1>River rises again</h1><p>The river rose by two metres overnight, officials said on Monday.</p>
      <p>Roads near the old bridge stay closed until the water falls.</p></div>
      <div id='disqus_thread'><p>Great article, thanks!</p></div><p class='legal'>All rights reserved 2020</p></body>""",
     ["River rises again", "The river rose by two metres overnight, officials said on Monday.", "Roads near the old bridge stay closed until the water falls."],
     ["Home News Sport", "Great article, thanks!", "All rights reserved 2020"]),
    ("""<table><tr><td><a href=a>Start</a><br><a href=b>Archive</a><br><a href=c>Contact</a></td>
      <td><h1>How to bake bread</h1><p>Mix the flour with water and a little salt, then wait for an hour.</p><p>Bake it for forty minutes.</p></td></tr>
      <tr><td colspan=2><small>Copyright 2004 by the author</small></td></tr></table>""",
     ["How to bake bread", "Mix the flour with water and a little salt, then wait for an hour.", "Bake it for forty minutes."],
     ["Start Archive Contact", "Copyright 2004 by the author"]),
    ("""<html><body><nav role=navigation><ul><li><a href=/1>Blog</a><li><a href=/2>About</a></ul></nav><main><article class="post hentry">
      <h2>Notes on a long walk</h2><p>We left the village at six and followed the stream up the valley.</p><blockquote>The hills are older than the maps.</blockquote>
      <pre>day 1: 20 km</pre></article></main><section class=responses><h3>2 responses</h3><p>I was there too.</p><p>Lovely pictures!</p></section>
      <footer><p>Imprint</p></footer></body></html>""",
     ["Notes on a long walk", "We left the village at six and followed the stream up the valley.", "The hills are older than the maps.", "day 1: 20 km"],
     ["Blog", "About", "2 responses", "I was there too.", "Lovely pictures!", "Imprint"]),
    ("""<div class="cookie-banner"><p>We use cookies to make this site better.</p><button>Accept</button></div><header><h2>The Daily</h2></header>
      <article><h1>Council votes on park</h1><p>The council voted on Tuesday to keep the park open in winter.</p><div class="ad"><p>Buy shoes now!</p></div>
      <p>A second vote is planned for spring.</p></article><aside><h3>Most read</h3><ul><li><a href=x>Storm warning</a></ul></aside>
      <div class="newsletter-signup"><form><p>Get our letter every week</p><input></form></div>""",
     ["Council votes on park", "The council voted on Tuesday to keep the park open in winter.", "A second vote is planned for spring."],
     ["We use cookies to make this site better.", "Accept", "The Daily", "Buy shoes now!", "Most read", "Storm warning", "Get our letter every week"]),
]


def test_extraction_of_pages_that_no_template_made(spark):
    rows = [(i, "u", page) for i, (page, _, _) in enumerate(HAND)]
    got = {r["page_id"]: r["text"].split("\n\n") for r in html_extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    kept = sum(t in got[i] for i, (_, main, _) in enumerate(HAND) for t in main)
    left = sum(t not in got[i] for i, (_, _, other) in enumerate(HAND) for t in other)
    wrong = [(i, t) for i, (_, main, other) in enumerate(HAND) for t in main + other if (t in main) != (t in got[i])]
    assert kept + left >= 0.9 * sum(len(m) + len(o) for _, m, o in HAND), wrong
    assert wrong == []


def test_extraction_finds_articles(spark):
    layouts = html_extraction.Layouts([f"word{i}" for i in range(300)], 77)
    made = [layouts.page() for _ in range(60)]
    rows = [(i, f"u{i}", page) for i, (page, _) in enumerate(made)] + [(900, None, None), (901, "u", ""), (902, "u", "<p")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in html_extraction.extract(pages).collect()}
    right = sum(got[i]["text"] == "\n\n".join(" ".join(t.split()) for t in texts) for i, (_, texts) in enumerate(made))
    assert right >= 54
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert (got[900]["text"], got[901]["text"], got[902]["text"]) == ("", "", "")
    assert html_extraction.extract(pages.limit(0)).isEmpty()


def test_lstm_gradients():
    r = np.random.default_rng(5)
    w = html_extraction.fresh(1)
    x = r.standard_normal((5, 2, html_extraction.INPUT)).astype(np.float32)
    mask, y = np.ones((5, 2), np.float32), (r.random((5, 2)) > 0.5).astype(np.float32)
    mask[3:, 1] = 0

    def loss(weights):
        p, _ = html_extraction.probabilities(x, mask, weights)
        return float(-((np.log(np.where(y > 0, p, 1 - p))) * mask).sum() / mask.sum())

    g = html_extraction.gradients(x, mask, y, w)
    for name, at in [("fx", (3, 7)), ("bh", (2, 20)), ("fc", (5,)), ("out", (20,)), ("skip", (9,)), ("bias", (0,))]:
        moved = {k: v.copy() for k, v in w.items()}
        moved[name][at] += 1e-2
        assert (loss(moved) - loss(w)) / 1e-2 == pytest.approx(float(g[name][at]), abs=2e-3)


# --- decontamination --------------------------------------------------------------------------------


def test_items_in_documents_equal_brute_force(spark, documents, clashing):
    r = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(r.choices(words, k=r.choice([2, 3, 4, 5, 12, 40])))) for i in range(30)] + [(90, None), (91, ""), (3, "w1 w2 w3 w4 w5 w6"), (92, "alone")]
    rows = []
    for i in range(80):
        text = " ".join(r.choices(words, k=r.choice([2, 30, 900])))
        if i % 2:
            inside = r.choice(items)[1] or ""
            parts = inside.split()
            if parts and r.random() < 0.5:
                parts[r.randrange(len(parts))] = "other"
            text = f"{text} {' '.join(parts).upper()}\n{text[:30]}"
        rows.append((i, text))
    rows += [(500, None), (501, ""), (1, rows[1][1]), (None, rows[3][1]), (502, "Alone"), (503, "w1 alone w1"), (504, "not-alone w1")]

    def sets(text, size):
        w = (text or "").lower().split()
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}

    want = set()
    for doc, text in rows:
        for item, passage in items:
            size = min(5, len((passage or "").split()))
            need = sets(passage, size) if size else set()
            if need and 100 * len(need & sets(text, size)) >= 80 * len(need):
                want.add((doc, item))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    docs = clashing(documents(*rows))
    got = decontamination.found_items(docs, table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    clean = decontamination.without_items(docs, table)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, _ in rows if d not in {x for x, _ in want})
    assert decontamination.found_items(documents(), table).isEmpty()
    assert decontamination.found_items(docs, table.limit(0)).isEmpty()


# --- pieces -----------------------------------------------------------------------------------------


def best_path(text, pieces):
    """Viterbi over the whole text, uncut."""
    table = {p: (i, s) for p, i, s in pieces.rows}
    text = " " + text if text else ""
    best = [(0.0, 0, None)]
    for j in range(1, len(text) + 1):
        found = None
        for n in range(1, min(max(pieces.bounds), j) + 1):
            part = text[j - n : j]
            if part in table:
                ids, score = [table[part][0]], table[part][1]
            elif n == 1:
                ids, score = [pieces.byte_ids[b] for b in part.encode()], pieces.unknown
            else:
                continue
            if found is None or (best[j - n][0] + score, n) > found[:2]:
                found = (best[j - n][0] + score, n, ids)
        best.append(found)
    out, j = [], len(text)
    while j:
        out = best[j][2] + out
        j -= best[j][1]
    return out


TEXTS = [
    "Hello world", "two  spaces   here ", " lead", "\n\nnew\nline \n x", "", None, "Tab\there", "naïve café ñandú", "日本語 text 🙂",
    "▁already▁", "internationalization unbelievable!!! ### $$$ 12345", "a", " ", "\n", "x" * 50, "the the the",
]


@pytest.mark.parametrize("most_words", [6_000_000, 5, 0])
def test_pieces_are_the_best_and_decode_to_the_text(documents, clashing, most_words):
    docs = clashing(documents(*enumerate(TEXTS), (0, TEXTS[0])))
    encoded = sentencepiece_lattice.encode(docs, most_words=most_words)
    rows = sentencepiece_lattice.decode(encoded).collect()
    pieces = sentencepiece_lattice.Pieces(sentencepiece_lattice.MODEL)
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        assert list(r["ids"]) == best_path(text, pieces)
        assert r["decoded"] == text
    assert encoded.columns == [*docs.columns, "ids"]


def test_long_runs_are_cut_and_still_decode(documents):
    texts = ["a" * 1000, " " * 300, "ab" * 500 + " c", "\n" * 200]
    rows = sentencepiece_lattice.decode(sentencepiece_lattice.encode(documents(*enumerate(texts)))).collect()
    assert {r["doc_id"]: r["decoded"] for r in rows} == dict(enumerate(texts))
    assert sentencepiece_lattice.encode(documents()).isEmpty()


@pytest.mark.parametrize("most_words", [6_000_000, 0])
def test_words_beyond_the_lattice_have_the_best_path(documents, most_words):
    r = random.Random(6)
    compound = "".join(r.choices(["inter", "national", "ization", "believ", "able", "schaft", "ungen", "pre", "é", "x"], k=400))
    texts = [compound, f"a {compound[:101]} b {compound[:64]} {compound[:65]}", " " * 150 + "word", "=" * 333 + "日" * 90, "the " * 40 + "-" * 70, "\n" * 100, compound]
    pieces = sentencepiece_lattice.Pieces(sentencepiece_lattice.MODEL)
    rows = sentencepiece_lattice.decode(sentencepiece_lattice.encode(documents(*enumerate(texts)), most_words=most_words)).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: best_path(t, pieces) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["decoded"] for r in rows} == dict(enumerate(texts))


@pytest.mark.parametrize("most_words", [6_000_000, 0])
def test_pieces_leave_columns_of_any_name_alone(documents, most_words):
    docs = documents((1, "one two"), (2, None)).withColumns({c: F.lit(c) for c in ["_extra", "_row", "row", "own", "_own"]})
    rows = sentencepiece_lattice.encode(docs, most_words=most_words).collect()
    assert len(rows) == 2 and all(r[c] == c for r in rows for c in ["_extra", "_row", "row", "own", "_own"])


def test_pieces_that_no_best_path_has_are_left_out(documents):
    pieces = sentencepiece_lattice.Pieces(sentencepiece_lattice.MODEL)
    left = {p for p, _ in pieces.edges}
    assert len(left) < len(pieces.rows) / 2 and {p for p, _, _ in pieces.rows if len(p) == 1} <= left
    r = random.Random(4)
    gone = r.sample(sorted({p for p, _, _ in pieces.rows} - left), 200)  # alone, side by side and among others
    texts = [" ".join(gone), "".join(gone), *("".join(r.choices(gone, k=3)) + r.choice(["", "é", " ", "x日", "12"]) for _ in range(60))]
    rows = sentencepiece_lattice.encode(documents(*enumerate(texts))).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: best_path(t, pieces) for i, t in enumerate(texts)}  # over all pieces


def test_words_are_cut_together_as_one_by_one():
    pieces = sentencepiece_lattice.Pieces(sentencepiece_lattice.MODEL)
    r = random.Random(8)
    words = ["".join(r.choices(" \naeinrstZ09.,-éß日🙂\0", k=r.randrange(1, 12))) for _ in range(3000)]
    parts, ends = sentencepiece_lattice.Cuts(pieces.pairs).start()(words)
    for word, a, b in zip(words, [0, *ends], ends, strict=False):
        want = word[0]
        for x, y in zip(word, word[1:], strict=False):
            want += y if x + y in pieces.pairs else "|" + y
        assert "|".join(parts[a:b]) == want
    assert ends[-1] == len(parts)


def test_back_pointers_are_followed_together_as_one_by_one():
    pieces, r = sentencepiece_lattice.Pieces(sentencepiece_lattice.MODEL), random.Random(9)
    last = [300, 5000, sentencepiece_lattice.UNKNOWN + ord("é")]
    paths = [[(r.randrange(1, min(j, 5) + 1) << 32) + r.choice(last) for j in range(1, n + 1)] for n in [1, 2, 9, 64, 65, 200, *range(1, 40)]]
    want = [sentencepiece_lattice.spelled(pieces.byte_ids, p) for p in paths]
    spell = lambda p: sentencepiece_lattice.spelled(pieces.byte_ids, p)
    ids, lengths = sentencepiece_lattice.followed(pa.array([[0], *paths], pa.list_(pa.int64())).slice(1), spell)
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


# --- bloom ------------------------------------------------------------------------------------------


def test_bloom_has_all_and_little_else(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    filled = Bloom(keys, 5000)
    own = np.array([r["h"] for r in keys.collect()], np.int64).view(np.uint64)
    other = np.array([r["h"] for r in spark.range(10_000, 30_000).select(F.xxhash64("id").alias("h")).collect()], np.int64).view(np.uint64)
    assert filled.has(own).all() and filled.has(other).mean() < 0.01
    assert not Bloom(keys.limit(0), 0).has(own).any()


def test_the_lattice_starts_no_python_workers(spark):
    places = spark.range(1).select(F.lit("abc").alias("key"), F.lit(0).alias("off"), F.lit("abc").alias("text"))
    edges = sentencepiece_lattice.edges_of(places, sentencepiece_lattice.Pieces(sentencepiece_lattice.MODEL))
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan  # rows of a list go through workers of their own kind, which stay


def test_batches_for_workers_are_small(spark, documents):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    texts = spark.range(0, 40, 1, 1).select(F.expr("repeat('some text ', 50000)").alias("text"))  # 20 MB

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    try:
        spark.conf.unset(name)
        sentencepiece_lattice.encode(documents((1, "a text")))
        found = [r["size"] for r in texts.mapInArrow(sizes, "size bigint").collect()]
        assert sum(found) > 20_000_000 and max(found) < 2 * shared.ARROW_BYTES
        spark.conf.set(name, "1000000")  # what the session was given stays
        sentencepiece_lattice.encode(documents((1, "a text")))
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_plan_texts_of_the_lattice_are_short(spark):
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    words = spark.range(3).select(F.lit("abc").alias("word"), F.lit(1).alias("n"), F.lit(3).alias("size"))
    with sentencepiece_lattice.lattice_settings(spark):
        paths = sentencepiece_lattice.best_paths(words, sentencepiece_lattice.Pieces(sentencepiece_lattice.MODEL))
        shown = paths._jdf.queryExecution().toString()
        assert paths.count() == 1
    assert len(shown) < 2 * sentencepiece_lattice.PLAN_TEXT and spark.conf.get(name) == before
