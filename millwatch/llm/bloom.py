"""Bloom filters built by tasks and sent to all tasks: they spare a shuffle of rows that cannot match.

A filter has a fixed largest size, so what is broadcast is bounded whatever the input; beyond that size more rows
pass it. It never decides a result: whatever passes is matched exactly afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millwatch.llm.words import mix

BITS_PER_KEY = 16
MOST_BITS = 1 << 29  # 64 MB
PROBES = 4
SLICE = 1 << 19  # bits


def positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit numbers for each key, one row per probe."""
    return np.stack([(mix(keys + np.uint64((0x9E3779B97F4A7C15 * (i + 1)) & (2**64 - 1))) & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)])


class Bloom:
    """Membership of 64-bit keys: no false negatives."""

    def __init__(self, keys: DataFrame, count: int) -> None:
        """keys: one long column without nulls, named h, of about `count` rows."""
        self.bits = bits = min(MOST_BITS, max(SLICE, 1 << (BITS_PER_KEY * max(1, count) - 1).bit_length()))
        spark = keys.sparkSession

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = positions(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits).ravel()
                yield pa.RecordBatch.from_arrays([pa.array((at // SLICE).astype(np.int32)), pa.array(at % SLICE)], names=["slice", "at"])

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets: dict[int, np.ndarray] = {}
            for batch in batches:
                slices, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for s in np.unique(slices):
                    bytes_of = sets.setdefault(int(s), np.zeros(SLICE // 8, np.uint8))
                    mine = at[slices == s]
                    np.bitwise_or.at(bytes_of, mine >> 3, (1 << (mine & 7)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int32()), pa.array([x.tobytes() for x in sets.values()], pa.binary())], names=["slice", "bits"])

        table = np.zeros(bits // 8, np.uint8)
        parts = max(1, min(64, bits // SLICE))
        for row in keys.mapInArrow(place, "slice int, at bigint").repartition(parts, "slice").mapInArrow(fill, "slice int, bits binary").toLocalIterator():
            start = row["slice"] * (SLICE // 8)
            table[start : start + SLICE // 8] = np.frombuffer(row["bits"], np.uint8)
        self.sent = spark.sparkContext.broadcast(table)

    def __getstate__(self) -> dict:
        return {"bits": self.bits, "sent": self.sent}

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which uint64 keys may be in the set."""
        table = self.sent.value
        found = np.ones(len(keys), bool)
        for at in positions(keys, self.bits):
            found &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found
