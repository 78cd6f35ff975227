"""Leaf blocks of an HTML page: runs of text between block-level tags, with the tags they stand in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())  # their content is no markup; unclosed they run to the end
HIDDEN = frozenset("noscript template svg select datalist option optgroup".split())  # elements whose text is not shown
FLAT = frozenset("noscript select datalist".split())  # never inside one of their own kind
CHOICES = frozenset("select option optgroup".split())  # hold no blocks: one that begins ends them
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY_SAME = frozenset(("li", "dt", "dd", "tr", "td", "th"))


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[str, ...]  # names of the open tags and words of their class, id and role, with and without the tag, outermost first
    link_chars: int


def _attribute_words(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    return [w for m in _NAMES.finditer(attributes) for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())]


class _Closings:
    """Whether an element is closed somewhere after a place of the page."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last: dict[str, int] = {}

    def __call__(self, name: str, at: int) -> bool:
        if name in FLAT:
            following = re.compile(rf"<(/?){name}(?=[\s/>])", re.I).search(self.page, at)
            return bool(following and following[1])
        if name not in self.last:
            self.last[name] = max((m.start() for m in re.finditer(rf"</{name}(?=[\s/>])", self.page, re.I)), default=-1)
        return self.last[name] >= at


def blocks(page: str) -> list[Block]:
    """The blocks in page order. White space is one space; character references are decoded. Scripts, styles,
    titles, comments, markup and HIDDEN elements give no text. Tags that are not closed end with the tag around
    them; a HIDDEN element that is never closed hides nothing, an option ends where a block begins."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    links, link_chars, at, end = 0, 0, 0, len(page)
    hidden: list[str] = []  # the open elements from the outermost hidden one on
    closed_after = _Closings(page)

    def add(text: str) -> None:
        nonlocal link_chars
        if text and not hidden:
            pieces.append(text)
            if links:
                link_chars += len(text)

    def flush() -> None:
        nonlocal link_chars
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, tuple(w for _, words in stack for w in words), link_chars))
            pieces.clear()
        link_chars = 0

    while at < end:
        m = _PART.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:-3]))
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if name in RAW and not closing:
            if not attributes.endswith("/"):
                done = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
                at = done.end() if done else end
            continue
        if hidden and not closing and name in CLOSES_P and name != "hr" and set(hidden) <= CHOICES:
            hidden.clear()
        if hidden:
            if not closing:
                if name in CHOICES or (name not in INLINE and name not in VOID and not attributes.endswith("/")):
                    hidden.append(name)
                continue
            if name in hidden:
                del hidden[len(hidden) - 1 - hidden[::-1].index(name) :]
                continue
            if not any(name == opened for opened, _ in stack):
                continue
            hidden.clear()
        elif name in HIDDEN:
            if not closing and not attributes.endswith("/") and (name in ("option", "optgroup") or closed_after(name, at)):
                hidden.append(name)
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name in ("br", "wbr", "img"):
                add(" ")
            continue
        flush()
        links = 0
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name in CLOSES_P and stack and stack[-1][0] == "p":
            stack.pop()
        if name in CLOSED_BY_SAME and stack and stack[-1][0] == name:
            stack.pop()
        if name not in VOID and not attributes.endswith("/"):
            stack.append((name, (name, *(x for w in _attribute_words(attributes) for x in (f"{name}.{w}", f".{w}")))))
    flush()
    return out
