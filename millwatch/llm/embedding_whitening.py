"""Whitening of embeddings: leading principal components of unit variance, the components by spectrum slicing.

Entries become whole numbers, floor(64 * c) + 1,000,000. Each distinct vector counts once in the fit. Its sums and centred
products are whole numbers too and are added up exactly, in tasks by blocks and then by Spark, whatever the size of the
entries; only d numbers, then d * d numbers, reach the driver. There the covariance is rounded once and its leading
eigenvalues are isolated, found and numbered (module spectrum). Every row is then projected where it lies.

Rows whose vector is null or empty or holds null or non-finite entries have no result rows. Where lengths differ, the length
that most distinct vectors have is the table's (of equals the longer), and rows of other lengths have no result. Repeated
rows have a result each. A component without variance (up to TINY of the trace) cannot be whitened and is left out,
so a table of equal vectors, or an empty one, gives an empty result. Entries beyond 2**62 / 64 count as that; a deviation
that does not fit a long is null. Only vec_id and embedding are read; other columns do not pass through, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.shared import ship, stored
from millwatch.llm.spectrum import leading

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
TINY = 1e-12
_LARGEST = float(1 << 62)
_LIMB = 20  # bits; a block of 2**13 products of such numbers is exact in a double
_BLOCK = 1 << 13
_WHOLE = pa.decimal128(38, 0)


def whole_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors of a list column as whole numbers without SHIFT, by length: (row numbers, matrix)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & (sizes > 0) & column.is_valid().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[usable]).tolist():
        rows = np.flatnonzero(usable & (sizes == d))
        entries = values[offsets[rows][:, None] + np.arange(d)]
        yield rows, np.clip(np.floor(entries * SCALE), -_LARGEST, _LARGEST).astype(np.int64)


def keys_of(y: np.ndarray) -> list[bytes]:
    """One string of bytes for each row, equal for equal rows: 16 bits an entry where that is enough for the row, else 64."""
    narrow = (np.abs(y) < 1 << 15).all(axis=1)
    short, wide = np.ascontiguousarray(y.astype("<i2")), np.ascontiguousarray(y.astype("<i8"))
    return [b"s" + short[i].tobytes() if n else b"w" + wide[i].tobytes() for i, n in enumerate(narrow.tolist())]


def rows_of(keys: list[bytes]) -> np.ndarray:
    """The matrix that keys_of() was given, for keys of one length of vectors."""
    return np.stack([np.frombuffer(k, "<i2" if k[:1] == b"s" else "<i8", offset=1).astype(np.int64) for k in keys])


def exact_sums(y: np.ndarray) -> list[int]:
    """The sum of each column."""
    low = y & ((1 << 31) - 1)
    return [(h << 31) + x for h, x in zip((y >> 31).sum(axis=0).tolist(), low.sum(axis=0).tolist())]


def exact_products(z: np.ndarray) -> np.ndarray:
    """The sums of the products of each two columns, as Python numbers."""
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for start in range(0, len(z), _BLOCK):
        rest, limbs = z[start : start + _BLOCK], []
        while rest.any():
            limb = ((rest + (1 << (_LIMB - 1))) & ((1 << _LIMB) - 1)) - (1 << (_LIMB - 1))
            limbs.append(limb.astype(np.float64))
            rest = (rest - limb) >> _LIMB
        for i, p in enumerate(limbs):
            for j, q in enumerate(limbs):
                total += (p.T @ q).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


def fit_list(vectors: DataFrame) -> DataFrame:
    """(d, key): each distinct vector once, with its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, y in whole_rows(batch.column(0)):
                keys = list(dict.fromkeys(keys_of(y)))
                yield pa.RecordBatch.from_arrays([pa.array([y.shape[1]] * len(keys), pa.int32()), pa.array(keys, pa.binary())], names=["d", "key"])

    return vectors.select("embedding").mapInArrow(run, "d int, key binary").distinct()


def column_sums(fit: DataFrame) -> list[int]:
    """The sum of each dimension over the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            if batch.num_rows:
                sums = exact_sums(rows_of(batch.column("key").to_pylist()))
                total = [a + b for a, b in zip(total, sums)] if total else sums
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, _WHOLE)], names=["i", "total"])

    rows = fit.mapInArrow(run, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total")).orderBy("i").collect()
    return [int(r["total"]) for r in rows]


def covariance(fit: DataFrame, n: int, centre: list[int], sums: list[int]) -> np.ndarray:
    """The covariance matrix, divisor n, rounded once: vectors are centred by whole numbers, what is left of their sums is taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre)
        total, at = np.zeros((d, d), object), np.array(centre, np.int64)
        for batch in batches:
            if batch.num_rows:
                total = total + exact_products(rows_of(batch.column("key").to_pylist()) - at)
        i, j = np.triu_indices(d)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([int(x) for x in total[i, j]], _WHOLE)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "total"])

    out = np.empty((len(centre), len(centre)))
    products = fit.mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    for i, j, total in products.collect():  # one row per two dimensions
        out[i, j] = out[j, i] = (n * int(total) - sums[i] * sums[j]) / (n * n)
    return out


class Whitening:
    """The fitted map: small, and tasks get it with their function."""

    def __init__(self, n: int, centre: list[int], sums: list[int], values: np.ndarray, vectors: np.ndarray) -> None:
        self.n, self.centre, self.sums = n, np.array(centre, np.int64), sums
        self.rest = np.array([s / n for s in sums])
        self.matrix = vectors / np.sqrt(values)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return ((y - self.centre) - self.rest) @ self.matrix

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n*x - S)^2 for each row, exact; None beyond a long."""
        z = y - self.centre
        most = self.n * int(np.abs(z).max(initial=0)) + max(map(abs, self.sums))
        if most * most * z.shape[1] < 1 << 62:
            return ((self.n * z - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in z.tolist()]
        return [x if x < 1 << 63 else None for x in exact]


def identity_error(fit: DataFrame, fitted: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity, measured on its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = fitted.matrix.shape[1]
        products, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                w = fitted.whitened(rows_of(batch.column("key").to_pylist()))
                products += w.T @ w
                sums += w.sum(axis=0)
        i, j = (x.ravel() for x in np.indices((k, k)))
        flat = np.concatenate([products.ravel(), sums])
        at = [np.concatenate([i, np.arange(k)]), np.concatenate([j, np.full(k, -1)])]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in at] + [pa.array(flat)], names=["i", "j", "total"])

    k = fitted.matrix.shape[1]
    out, means = np.zeros((k, k)), np.zeros(k)
    for i, j, total in fit.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        if j < 0:
            means[i] = total / fitted.n
        else:
            out[i, j] = total / fitted.n
    return float(np.abs(out - np.outer(means, means) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component, from 1 by falling variance: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    distinct = stored(fit_list(vectors))
    lengths = distinct.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d, n = lengths["d"], lengths["count"]
    fit = distinct.where(F.col("d") == d).select("key")
    sums = column_sums(fit)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    sums = [s - n * c for s, c in zip(sums, centre)]
    matrix = covariance(fit, n, centre, sums)
    trace = float(np.trace(matrix))
    values, directions = leading(matrix, components)
    kept = int((values > TINY * trace).sum())
    if not kept:
        return spark.createDataFrame([], schema)
    fitted = Whitening(n, centre, sums, values[:kept], directions[:, :kept])
    explained = values[:kept] / trace
    error = identity_error(fit, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, y in whole_rows(batch.column("embedding")):
                if y.shape[1] != d:
                    continue
                each = np.repeat(np.arange(len(rows)), kept)
                columns = [
                    batch.column("vec_id").take(pa.array(rows[each])),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), n, np.int64)),
                    pa.array(fitted.deviations(y), pa.int64()).take(pa.array(each)),
                    pa.array(fitted.whitened(y).ravel()),
                    pa.array(np.tile(explained, len(rows))),
                    pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)
