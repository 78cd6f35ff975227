"""Sorted runs of byte strings with their common prefixes: front coding and an LCP-aware loser tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def common_prefixes(keys: list[bytes], width: int) -> np.ndarray:
    """The number of first bytes that each key shares with the one before it; 0 for the first. No key is longer than `width`."""
    lengths = np.fromiter(map(len, keys), np.int64, len(keys))
    grid = np.frombuffer(b"".join(k.ljust(width, b"\0") for k in keys), np.uint8).reshape(-1, width)
    out = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[1:] = np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))
    return out


def front_coded(keys: list[bytes], width: int) -> tuple[bytes, bytes, bytes]:
    """Sorted keys as (common prefix lengths, tail lengths, tails)."""
    shared = common_prefixes(keys, width)
    tails = [k[s:] for k, s in zip(keys, shared.tolist(), strict=True)]
    return shared.astype(np.uint16).tobytes(), np.fromiter(map(len, tails), np.uint16, len(tails)).tobytes(), b"".join(tails)


def decoded(shared: bytes, lengths: bytes, tails: bytes) -> Iterator[tuple[int, bytes]]:
    """(common prefix with the one before, key) of a front-coded run."""
    at, key = 0, b""
    for s, n in zip(np.frombuffer(shared, np.uint16).tolist(), np.frombuffer(lengths, np.uint16).tolist(), strict=True):
        key = key[:s] + tails[at : at + n]
        at += n
        yield s, key


def first_difference(x: bytes, y: bytes, at: int) -> int:
    """The first place from `at` on where x and y differ, or the length of the shorter."""
    while (part := x[at : at + 16]) == y[at : at + 16] and part:
        at += 16
    most = min(len(x), len(y))
    while at < most and x[at] == y[at]:
        at += 1
    return min(at, most)


def merged(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """(common prefix with the output before, key, run) over all runs in order, by a loser tree.

    Every head carries its common prefix with the last output that beat it. Of two heads the one with the
    longer common prefix is smaller, without a look at their bytes; at equal length the bytes after it decide.
    So no byte known to be equal is compared again.
    """
    k = len(runs)
    if not k:
        return
    size = 1 << (k - 1).bit_length() if k > 1 else 1
    heads: list[bytes | None] = [None] * size
    known = [0] * size
    for i, run in enumerate(runs):
        _, heads[i] = next(run, (0, None))

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's common prefix with the winner is set."""
        x, y = heads[a], heads[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        at = first_difference(x, y, known[a])
        if x[at : at + 1] < y[at : at + 1] or (x[at : at + 1] == y[at : at + 1] and a < b):
            known[b] = at
            return a, b
        known[a] = at
        return b, a

    losers = [0] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while (key := heads[winner]) is not None:
        yield known[winner], key, winner
        known[winner], heads[winner] = next(runs[winner], (0, None))
        node = (winner + size) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1
