"""Main text of web pages by a recurrent block labeller: a bidirectional LSTM in numpy.

A page is the sequence of its leaf blocks. A block's vector holds its hashed tag path (tag names and the words of
class, id and role attributes), its hashed words and a few measures. One LSTM reads the sequence forwards,
one backwards; from both states each block gets the probability of being main text, with the whole page as context.

Training pages are laid out by templates (many ways to write menus, headers, footers, sidebars, notices,
adverts, forms, comments and articles), filled with words of a bounded sample of the pages at hand; the template
knows which blocks are main text. Pages are labelled in tasks, in batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.html_blocks import Block, blocks
from millwatch.llm.shared import ship
from millwatch.llm.words import slices

PATH, WORD, MEASURES, STATE = 256, 24, 8, 16
INPUT = PATH + WORD + MEASURES
SAMPLE_PAGES = 200  # whose words fill the training pages
VOCABULARY, LONGEST_FILLER = 5_000, 40  # so many distinct words, of so many characters at most
TRAIN_PAGES, STEPS, BATCH, RATE, SEED = 1200, 400, 32, 0.01, 11
THRESHOLD = 0.5
BATCH_BLOCKS = 6_000

Weights = dict[str, np.ndarray]


def _bucket(word: str, n: int, seed: int) -> int:
    return xxhash.xxh32_intdigest(word, seed) % n


def vectors(page: list[Block], path_memo: dict, word_memo: dict) -> np.ndarray:
    """One row per block."""
    out = np.zeros((len(page), INPUT), np.float32)
    total = sum(len(b.text) for b in page) or 1
    for i, b in enumerate(page):
        found = path_memo.get(b.path)
        if found is None:
            if len(path_memo) > 50_000:
                path_memo.clear()
            found = path_memo[b.path] = list({_bucket(w, PATH, 1) for w in b.path})
        out[i, found] = 1
        words = b.text.split()
        places = []
        for w in words:
            at = word_memo.get(w)
            if at is None:
                if len(word_memo) > 200_000:
                    word_memo.clear()
                at = word_memo[w] = _bucket(w.lower(), WORD, 2)
            places.append(at)
        if words:
            out[i, PATH : PATH + WORD] = np.bincount(places, minlength=WORD) / np.sqrt(len(words))
        n = len(b.text)
        out[i, PATH + WORD :] = (
            np.log1p(len(words)) / 5,
            b.link_chars / n if n else 0,
            i / len(page),
            n / total,
            len(b.path) / 10,
            b.text[-1:] in ".!?",
            "©" in b.text,
            1,
        )
    return out


def fresh(seed: int = SEED) -> Weights:
    r = np.random.default_rng(seed)
    w: Weights = {}
    for way in ("f", "b"):
        w[f"{way}x"] = (r.standard_normal((INPUT, 4 * STATE)) / 4).astype(np.float32)
        w[f"{way}h"] = (r.standard_normal((STATE, 4 * STATE)) / np.sqrt(STATE)).astype(np.float32)
        w[f"{way}c"] = np.concatenate([np.zeros(STATE), np.ones(STATE), np.zeros(2 * STATE)]).astype(np.float32)
    w["out"] = (r.standard_normal(2 * STATE) / np.sqrt(2 * STATE)).astype(np.float32)
    w["skip"] = np.zeros(INPUT, np.float32)
    w["bias"] = np.zeros(1, np.float32)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _read(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, list]:
    """The states of an LSTM over (time, page, input); where mask is 0 the state stays."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, STATE), np.float32), np.zeros((n, STATE), np.float32)
    states, trace = np.zeros((steps, n, STATE), np.float32), []
    given = x @ wx + bias
    for t in range(steps):
        z = given[t] + h @ wh
        i, f, o = (_sigmoid(z[:, k * STATE : (k + 1) * STATE]) for k in range(3))
        g = np.tanh(z[:, 3 * STATE :])
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        m = mask[t][:, None]
        trace.append((h, c, i, f, o, g, tanh_c, m))
        c = m * new_c + (1 - m) * c
        h = m * (o * tanh_c) + (1 - m) * h
        states[t] = h
    return states, trace


def _back(x: np.ndarray, d_states: np.ndarray, trace: list, wx: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gradients of the LSTM's weights."""
    steps, n, _ = x.shape
    dz_all = np.zeros((steps, n, 4 * STATE), np.float32)
    dh, dc, d_wh = np.zeros((n, STATE), np.float32), np.zeros((n, STATE), np.float32), np.zeros_like(wh)
    for t in range(steps - 1, -1, -1):
        h0, c0, i, f, o, g, tanh_c, m = trace[t]
        dh = dh + d_states[t]
        d_new_h = dh * m
        d_new_c = dc * m + d_new_h * o * (1 - tanh_c**2)
        dz = np.hstack([d_new_c * g * i * (1 - i), d_new_c * c0 * f * (1 - f), d_new_h * tanh_c * o * (1 - o), d_new_c * i * (1 - g**2)])
        dz_all[t] = dz
        d_wh += h0.T @ dz
        dh = dh * (1 - m) + dz @ wh.T
        dc = dc * (1 - m) + d_new_c * f
    flat = dz_all.reshape(-1, 4 * STATE)
    return x.reshape(-1, x.shape[2]).T @ flat, d_wh, flat.sum(axis=0)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), INPUT), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


def probabilities(x: np.ndarray, mask: np.ndarray, w: Weights) -> tuple[np.ndarray, tuple]:
    ahead, trace_f = _read(x, mask, w["fx"], w["fh"], w["fc"])
    behind, trace_b = _read(x[::-1], mask[::-1], w["bx"], w["bh"], w["bc"])
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    return _sigmoid(both @ w["out"] + x @ w["skip"] + w["bias"][0]), (both, trace_f, trace_b)


def gradients(x: np.ndarray, mask: np.ndarray, y: np.ndarray, w: Weights) -> Weights:
    p, (both, trace_f, trace_b) = probabilities(x, mask, w)
    d = ((p - y) * mask / mask.sum()).astype(np.float32)
    d_both = d[..., None] * w["out"]
    g = {"out": (both * d[..., None]).sum(axis=(0, 1)), "skip": (x * d[..., None]).sum(axis=(0, 1)), "bias": np.array([d.sum()])}
    g["fx"], g["fh"], g["fc"] = _back(x, d_both[..., :STATE], trace_f, w["fx"], w["fh"])
    g["bx"], g["bh"], g["bc"] = _back(x[::-1], d_both[::-1, :, STATE:], trace_b, w["bx"], w["bh"])
    return g


class Layouts:
    """Training pages: (html, the texts of its main blocks in order)."""

    def __init__(self, vocabulary: list[str], seed: int) -> None:
        self.r = np.random.default_rng(seed)
        self.vocabulary = vocabulary or ["word", "text", "page"]

    def some(self, *options):
        return options[int(self.r.integers(len(options)))]

    def words(self, low: int, high: int) -> str:
        n = int(self.r.integers(low, high + 1))
        return " ".join(self.vocabulary[int(i)] for i in self.r.integers(len(self.vocabulary), size=n))

    def links(self, n: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 2)}</a>' for i in range(n)]
        return self.some("<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", " | ".join(items), " ".join(items))

    def clutter(self, where: str) -> str:
        """A part of the page that is not main text."""
        n = int(self.r.integers(2, 8))
        text = self.words(3, 40)
        menu = self.links(n)
        if where == "before":
            return self.some(
                f"<nav>{menu}</nav>", f'<div class="menu">{menu}</div>', f'<div id="navigation">{menu}</div>', f"<header>{self.words(1, 6)}{menu}</header>",
                f"<header><h2>{self.words(1, 5)}</h2></header>", f'<div class="ad">{text}</div>', f'<div class="cookie-notice">{text}<button>{self.words(1, 2)}</button></div>',
                f'<div class="banner">{text}</div>', f'<form class="search"><input name="q"><button>{self.words(1, 1)}</button></form>', f'<div class="notice" role="alert"><p>{text}</p></div>',
                f'<table><tr><td>{menu}</td></tr></table>', f'<div>{menu}</div>', f"<dialog><p>{text}</p><button>{self.words(1, 2)}</button></dialog>", f'<p class="promo">{text}</p>',
                f'<select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select>', f'<div class="topbar">{menu}</div>', f'<noscript><p>{text}</p></noscript>',
                f'<ol class="breadcrumb"><li>{self.words(1, 1)}</li><li>{self.words(1, 2)}</li></ol>', f'<!-- x --><div class="advert"><p>{text}</p></div>',
            )
        if where == "inside":
            return self.some(
                f'<div class="ad">{text}</div>', f'<aside><p>{text}</p></aside>', f'<div class="share">{menu}</div>', f'<form><label>{self.words(1, 3)}</label><input></form>',
                f'<div class="related">{menu}</div>', f'<div class="sponsored"><p>{text}</p></div>', f'<p class="advertisement">{text}</p>', f'<ul class="social"><li>{menu}</li></ul>',
                f'<div class="newsletter"><p>{text}</p><button>{self.words(1, 2)}</button></div>',
            )
        comments = "".join(f'<{t} class="comment"><p>{self.words(2, 40)}</p></{t}>' for t in ["div"] * int(self.r.integers(1, 4)))
        return self.some(
            f"<footer>&copy; {text}</footer>", f"<footer><p>{text}</p>{menu}</footer>", f'<div class="footer">{text}</div>', f'<div id="footer"><p>{text}</p></div>',
            f"<aside><h3>{self.words(1, 3)}</h3>{menu}</aside>", f'<div class="sidebar"><p>{text}</p>{menu}</div>', f'<section id="comments"><h2>{self.words(1, 2)}</h2>{comments}</section>',
            f'<div class="comments">{comments}</div>', f"<form><p>{text}</p><textarea></textarea></form>", f'<div class="ad">{text}</div>', f'<ul class="comment-list"><li>{self.words(3, 30)}</li><li>{self.words(3, 30)}</li></ul>',
            f'<div class="related"><h3>{self.words(1, 3)}</h3>{menu}</div>', self.discussion(), self.discussion(), self.legal(), self.legal(),
        )

    def discussion(self) -> str:
        """What readers say, in the markup of a widget."""
        name = self.some("disqus_thread", "disqus", "discussion", "responses", "replies", "reply-list", "user-comments", "fb-comments", "reviews", "guestbook", "thread")
        one = self.some("reply", "response", "comment-body", "message", "review", "")
        label = f' class="{one}"' if one else ""
        tag = self.some("div", "p", "li", "article", "blockquote")
        said = "".join(f"<{tag}{label}>{self.some('', f'<b>{self.words(1, 2)}</b> ')}{self.words(2, 40)}{self.some('.', '!', '?', '')}</{tag}>" for _ in range(int(self.r.integers(1, 5))))
        kind = self.some("id", "class")
        return self.some(f'<div {kind}="{name}">{said}</div>', f'<section {kind}="{name}"><h3>{self.words(1, 2)}</h3>{said}</section>', f'<ul {kind}="{name}">{said}</ul>')

    def legal(self) -> str:
        """A line about rights or terms."""
        line = self.some("All rights reserved", "Terms of use", "Privacy policy", "&copy; 2019", "Copyright 2021", "Imprint") + " " + self.words(0, 20)
        name = self.some("legal", "copyright", "disclaimer", "terms", "colophon", "imprint", "fineprint", "")
        label = f' class="{name}"' if name else ""
        tag = self.some("p", "div", "section", "address") if name else "footer"
        return f"<{tag}{label}>{self.some(line, f'<small>{line}</small>', f'<p>{line}</p>')}</{tag}>"

    def paragraph(self) -> tuple[str, str]:
        text = self.words(1, self.some(8, 30, 90, 200)) + self.some(".", ".", "", "!")
        if self.r.random() < 0.15:  # tables, shouting, symbols and repeats are main text all the same
            text = self.some(text.replace(" ", " | "), text.upper(), text.replace(" ", "### "), " ".join([text[:60]] * 4), text.replace(" ", "!! "))
        kind = self.some("p", "p", "p", "p", "h2", "li", "blockquote", "pre", "div", "open", "bold", "link")
        if kind == "open":
            return f"<p><b>{text}<br>", text
        if kind == "bold":
            return f"<p><b>{text}</b></p>", text
        if kind == "link":
            word = self.words(1, 2)
            return f'<p>{text} <a href="/x">{word}</a> {word}</p>', f"{text} {word} {word}"
        if kind == "li":
            return f"<ul><li>{text}</li></ul>", text
        return f"<{kind}>{text}</{kind}>", text

    def page(self) -> tuple[str, list[str]]:
        title = self.words(2, 10)
        parts, texts = [], []
        if self.r.random() < 0.85:
            parts.append(f"<h1>{title}</h1>")
            texts.append(title)
        for _ in range(int(self.r.integers(1, self.some(3, 8, 16)))):
            if self.r.random() < 0.08:
                parts.append(self.clutter("inside"))
            markup, text = self.paragraph()
            parts.append(markup)
            texts.append(text)
        opened, closed = self.some(("<article>", "</article>"), ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main"><div class="post">', "</div></div>"), ('<div class="article-body">', "</div>"), ('<section class="entry">', "</section>"), ('<table><tr><td class="body">', "</td></tr></table>"), ("<div>", "</div>"), ('<div role="main">', "</div>"), ('<div class="story text">', "</div>"))
        before = "".join(self.clutter("before") for _ in range(int(self.r.integers(0, 4))))
        after = "".join(self.clutter("after") for _ in range(int(self.r.integers(0, 4))))
        head = f'<html><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
        return head + before + opened + "".join(parts) + closed + after + self.some("</body></html>", ""), texts


def training_set(vocabulary: list[str], n: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    layouts, path_memo, word_memo, out = Layouts(vocabulary, seed), {}, {}, []
    for _ in range(n):
        page, texts = layouts.page()
        found, y, at = blocks(page), [], 0
        for b in found:
            hit = at < len(texts) and b.text == " ".join(texts[at].split())
            y.append(float(hit))
            at += hit
        if found and at == len(texts):
            out.append((vectors(found, path_memo, word_memo), np.array(y, np.float32)))
    return out


def train(vocabulary: list[str], pages: int = TRAIN_PAGES, steps: int = STEPS, seed: int = SEED) -> Weights:
    examples = training_set(vocabulary, pages, seed)
    w, r = fresh(seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for t in range(1, steps + 1):
        chosen = [examples[int(i)] for i in r.integers(len(examples), size=BATCH)]
        x, mask = padded([v for v, _ in chosen])
        y = np.zeros(mask.shape, np.float32)
        for k, (_, labels) in enumerate(chosen):
            y[: len(labels), k] = labels
        g = gradients(x, mask, y, w)
        rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
        for k in w:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
            w[k] = (w[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)
    return w


def main_texts(pages: list[str], w: Weights, path_memo: dict, word_memo: dict) -> list[str]:
    """The main text of each page: the blocks above THRESHOLD, joined by an empty line."""
    found = [blocks(p) for p in pages]
    order = sorted((i for i, f in enumerate(found) if f), key=lambda i: len(found[i]))
    out = [""] * len(pages)
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(found[order[end]]) * (end + 1 - at) <= BATCH_BLOCKS:
            end += 1
        group = order[at:end]
        p, _ = probabilities(*padded([vectors(found[i], path_memo, word_memo) for i in group]), w)
        for k, i in enumerate(group):
            out[i] = "\n\n".join(b.text for b, q in zip(found[i], p[:, k], strict=False) if q >= THRESHOLD)
        at = end
    return out


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    Null and empty pages, and pages without main text, have an empty text. Repeated rows are read each. An empty
    table gives an empty result. The words of the training pages come from the `sample_pages` pages with the
    smallest hash of their id: of all their words of at most LONGEST_FILLER characters, the VOCABULARY with the
    smallest hash.
    """
    ship(pages.sparkSession)
    ids = pages.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    sample = pages.select("page_id", "html").join(F.broadcast(ids.distinct()), "page_id")
    shown = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    words = sample.select(F.explode(F.split(shown, r"\s+")).alias("word")).where(F.length("word").between(1, LONGEST_FILLER) & ~F.col("word").rlike("[&<>]"))
    seen = sorted(r["word"] for r in words.distinct().orderBy(F.xxhash64("word"), "word").limit(VOCABULARY).collect())
    sent = pages.sparkSession.sparkContext.broadcast(train(seen))
    given = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in given.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path_memo, word_memo = {}, {}
        for batch in slices(batches, "html", 2 << 20):
            texts = main_texts([p or "" for p in batch.column("html").to_pylist()], sent.value, path_memo, word_memo)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return given.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
