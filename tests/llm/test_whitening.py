"""Spectrum slicing against a dense solver, whitening against exact arithmetic by hand."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwatch.llm import embedding_whitening as EW
from millwatch.llm.spectrum import below, leading


@pytest.mark.parametrize("kind", ["spread", "repeated", "steep", "equal", "one"])
@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_leading_eigenvalues(kind, d):
    r = np.random.default_rng(d)
    q, _ = np.linalg.qr(r.standard_normal((d, d)))
    e = {
        "spread": r.random(d) * 100,
        "repeated": np.round(r.random(d) * 3) * 30 + 1,
        "steep": np.geomspace(1e6, 1e-6, d),
        "equal": np.full(d, 7.0),
        "one": np.eye(1, d)[0] * 5,
    }[kind]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    want = np.linalg.eigvalsh(a)
    for shift in r.random(5) * 100:
        assert below(a, shift) == (want < shift).sum()
    values, vectors = leading(a, 16)
    k = min(16, d)
    assert np.abs(values - want[::-1][:k]).max() <= 1e-13 * np.abs(want).max()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * np.abs(want).max()


def test_sums_and_products_are_exact():
    r = random.Random(1)
    for size in (10, 1 << 25, 1 << 45, 1 << 61):
        rows = [[r.randrange(-size, size) for _ in range(4)] for _ in range(50)]
        y = np.array(rows, np.int64)
        assert EW.exact_sums(y) == [sum(c) for c in zip(*rows)]
        assert EW.exact_products(y).tolist() == [[sum(x[i] * x[j] for x in rows) for j in range(4)] for i in range(4)]
        assert EW.rows_of(EW.keys_of(y)).tolist() == rows


def whitened_by_hand(rows, components):
    """{id: [(deviation, whitened up to sign, explained)]} in Python numbers, the components by a dense solver."""
    usable = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, d = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    v = np.array([[float(sum((Fraction(x[i]) - Fraction(sums[i], n)) * (Fraction(x[j]) - Fraction(sums[j], n)) for x in fit) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    out = {}
    for i, x in usable:
        centred = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums)])
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out.setdefault(i, []).append((deviation, centred @ u / np.sqrt(e), e / np.trace(v)))
    return n, out


def vectors_of(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}, label int")


def test_whitening(spark, clashing):
    r = random.Random(2)
    mixing = [[r.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    rows = []
    for i in range(120):
        z = [r.gauss(0, 1) for _ in range(6)]
        rows.append((i, [float(np.float32(sum(a * b for a, b in zip(z, m)) + 3)) for m in mixing]))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (3, rows[4][1]), (202, None), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    rows += [(204, [float("nan")] * 6), (205, [float("inf")] + [0.0] * 5), (206, []), (207, [1.0, 2.0])]
    df = clashing(vectors_of(spark, [(*x, 1) for x in rows])).withColumn("component", F.lit("x")).withColumn("d", F.lit(1))
    got = EW.whiten(df.repartition(5), components=4).collect()
    n, want = whitened_by_hand([x for x in rows if x[0] != 207], 4)
    by_id = {}
    for x in got:
        by_id.setdefault(x["vec_id"], []).append(x)
    assert set(by_id) == set(want) and {len(x) for i, x in by_id.items() if i != 3} == {4} and len(by_id[3]) == 8
    signs = {}
    for i, found in by_id.items():
        if i == 3:
            continue
        (deviation, white, explained), *_ = want[i]
        for x in found:
            k = x["component"] - 1
            assert x["n"] == n and x["deviation"] == deviation and x["identity_error"] < 1e-9
            assert abs(x["explained"] - explained[k]) < 1e-12
            sign = signs.setdefault(k, np.sign(x["whitened"] * white[k]))
            assert abs(x["whitened"] - sign * white[k]) < 1e-9


def test_large_entries_and_missing_variance(spark):
    rows = [(i, [float(i), 5.0, -float(i) * 3, 1e13 * (i % 3)], 0) for i in range(30)]
    got = EW.whiten(vectors_of(spark, rows, "array<double>")).collect()
    assert {x["component"] for x in got} <= {1, 2} and len(got) >= 30
    _, want = whitened_by_hand([x[:2] for x in rows], 1)
    for x in got:
        exact = want[x["vec_id"]][0][0]
        assert x["deviation"] == (exact if exact < 1 << 63 else None)


def test_nothing_to_whiten(spark):
    assert EW.whiten(vectors_of(spark, [])).isEmpty()
    assert EW.whiten(vectors_of(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).isEmpty()
    assert EW.whiten(vectors_of(spark, [(1, None, 0)])).isEmpty()
