"""A minimal acyclic transducer from words to lists of ids, in flat arrays that a process can map from a file.

The words are added in byte order. What the next word leaves behind is complete: its states are looked up by their final
mark and transitions, so equal suffixes are kept once and the automaton is minimal. A transition's output is the number of
words that sort before those behind it; the outputs along a word add up to its number, and the number leads to its ids.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Lexicon:
    """Look-up of many words at once; `flat` is one array of 64-bit numbers, as compiled() makes it."""

    def __init__(self, flat: np.ndarray) -> None:
        n_states, n_moves, n_words, n_ids, self.longest = (int(x) for x in flat[:5])
        cuts = np.cumsum([5, n_moves, n_moves, n_moves, n_states, n_words + 1, n_ids])
        self.keys, self.targets, self.outputs, self.final, self.offsets, self.ids = (flat[a:b] for a, b in zip(cuts, cuts[1:]))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon. All words take their next byte in the same step."""
        out = np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rows = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        if not len(rows) or not len(self.keys):
            return out
        order = rows[np.argsort(-lengths[rows], kind="stable")]  # those still going are always the first
        sizes = lengths[order]
        letters = np.zeros((len(order), int(sizes[0])), np.uint8)
        letters[np.arange(letters.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join([words[i] for i in order.tolist()]), np.uint8)
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for k in range(letters.shape[1]):
            going = int(np.searchsorted(-sizes, -k, side="left"))  # sizes > k
            key = (np.maximum(state[:going], 0) << 8) | letters[:going, k]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (state[:going] >= 0)
            total[:going] += np.where(hit, self.outputs[at], 0)
            state[:going] = np.where(hit, self.targets[at], -1)
        found = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        out[order[found]] = total[found]
        return out

    def packed(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as 32-bit numbers, None where it is not in the lexicon."""
        numbers = self.numbers(words)
        starts, stops = self.offsets[numbers], self.offsets[numbers + 1]
        sizes = np.where(numbers >= 0, stops - starts, 0)
        ends = np.cumsum(sizes)
        flat = self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(sizes.sum()))].astype(np.int32).tobytes()
        ends = (4 * ends).tolist()
        return [flat[a:b] if n >= 0 else None for n, a, b in zip(numbers.tolist(), [0, *ends], ends)]


def compiled(entries: Iterable[tuple[bytes, list[int]]]) -> np.ndarray:
    """The lexicon of distinct, non-empty words in byte order."""
    known: dict[tuple, int] = {}  # (final, transitions) to state
    states: list[tuple] = []
    sizes: list[int] = []  # words behind each state

    def closed(final: bool, moves: list[tuple[int, int]]) -> int:
        key = (final, tuple(moves))
        at = known.get(key)
        if at is None:
            at = known[key] = len(states)
            states.append(key)
            sizes.append(final + sum(sizes[target] for _, target in moves))
        return at

    path: list[list] = [[False, []]]  # the open states along the last word
    last, longest = b"", 0
    offsets, ids = [0], []
    for word, of_word in entries:
        if word <= last:
            raise ValueError("words must be distinct and in byte order")
        shared = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        for depth in range(len(last), shared, -1):
            final, moves = path.pop()
            path[-1][1].append((last[depth - 1], closed(final, moves)))
        path.extend([False, []] for _ in range(shared, len(word)))
        path[-1][0] = True
        ids.extend(of_word)
        offsets.append(len(ids))
        last, longest = word, max(longest, len(word))
    for depth in range(len(last), 0, -1):
        final, moves = path.pop()
        path[-1][1].append((last[depth - 1], closed(final, moves)))
    root = closed(*path[0])

    number = {root: 0}  # the first state is the root
    for state in range(len(states)):
        number.setdefault(state, len(number))
    finals = np.zeros(len(states), np.int64)
    rows = []
    for state, (final, moves) in enumerate(states):
        finals[number[state]] = final
        before = int(final)
        for byte, target in moves:
            rows.append((number[state] << 8 | byte, number[target], before))
            before += sizes[target]
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    head = [len(states), len(rows), len(offsets) - 1, len(ids), longest]
    return np.concatenate([np.array(head, np.int64), *table.T, finals, np.array(offsets, np.int64), np.array(ids, np.int64)])
