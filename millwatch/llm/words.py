"""Words and hashes of whole texts, for functions that run on Arrow batches.

A word is a maximal run of bytes other than space and \\x09-\\x0D. Those are ASCII, so splitting the UTF-8
bytes gives the same words as splitting the code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_MASK = (1 << 64) - 1


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; a null counts as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """Word to 64-bit hash. Forgets its entries when it has many: it only saves time, it decides nothing."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` consecutive words; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64))
    return mix(total)


def window_sums(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash (modulo 2**64, odd base) of each window of `size` values, by prefix sums."""
    n = len(values)
    if n < size:
        return np.empty(0, np.uint64)
    powers = _powers(base, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers, out=sums[1:])
    inverse = _powers(pow(base, -1, 1 << 64), n)
    return mix((sums[size:] - sums[:-size]) * inverse[: n - size + 1])


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64, kept for the next text."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        got = np.empty(size, np.uint64)
        got[0] = 1
        got[1:] = np.uint64(base)
        np.multiply.accumulate(got, out=got)
        if size <= 1 << 22:
            _POWERS[base] = got
    return got[:n]


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as a Spark long."""
    return np.ascontiguousarray(h).view(np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `limit` bytes of `column`, or one row if that is longer."""
    for batch in batches:
        lengths = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = lengths[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(lengths, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
