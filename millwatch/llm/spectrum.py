"""Leading eigenvalues of a symmetric matrix by spectrum slicing.

A shifted matrix A - s*I is factored as LDL' with diagonal blocks of one or two (pivoted by its largest entry); by Sylvester's law the
negative eigenvalues of D are as many as those of A below s. Bisection with these counts isolates an eigenvalue,
Rayleigh quotient iteration converges to it, and two more counts certify its number.
"""

from __future__ import annotations

import numpy as np

_PIVOT = (1 + 17**0.5) / 8  # bounds the growth of entries


def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric `a` are below `shift`: the inertia of its LDL' factors."""
    m = a - shift * np.eye(len(a))
    count = 0
    while len(m):
        diagonal = np.abs(m.diagonal())
        k = int(diagonal.argmax())
        off = np.abs(np.tril(m, -1))
        i, j = divmod(int(off.argmax()), len(m))
        if diagonal[k] == 0 and off[i, j] == 0:
            break  # nothing but zeros is left
        if diagonal[k] >= _PIVOT * off[i, j]:
            pivots = [k]
        else:
            pivots = [i, j]
        rest = np.delete(np.arange(len(m)), pivots)
        block, side = m[np.ix_(pivots, pivots)], m[np.ix_(rest, pivots)]
        if len(pivots) == 1:
            count += int(block[0, 0] < 0)
            m = m[np.ix_(rest, rest)] - np.outer(side[:, 0], side[:, 0]) / block[0, 0]
        else:  # an entry outside the diagonal dominates: one eigenvalue of the block is negative, the other positive
            count += 1
            m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return count


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues that no double between them parts are found one after the other, each vector at right angles to the ones before.
    """
    n = len(a)
    wanted = min(wanted, n)
    scale = max(float(np.abs(a).sum(axis=1).max()), np.finfo(float).tiny)
    tight = 4 * n * np.finfo(float).eps * scale
    counts: dict[float, int] = {}

    def at_least(shift: float) -> int:
        """How many eigenvalues are not below the shift."""
        if shift not in counts:
            counts[shift] = n - below(a, shift)
        return counts[shift]

    counts[-scale - tight], counts[scale + tight] = n, 0
    values, vectors = np.empty(wanted), np.empty((n, wanted))
    for number in range(1, wanted + 1):
        low = max(s for s, c in counts.items() if c >= number)
        high = min(s for s, c in counts.items() if c < number)
        others = vectors[:, : number - 1]
        while True:
            alone = at_least(low) == number and at_least(high) == number - 1
            if (alone and high - low < 0.1 * scale) or high - low <= tight:
                start = _start(a, (low + high) / 2, others, number)
                value, vector = rayleigh(a, start, others, tight)
                if high - low <= tight or (low <= value <= high and at_least(value - tight) >= number > at_least(value + tight)):
                    values[number - 1], vectors[:, number - 1] = value, vector
                    break
            middle = (low + high) / 2
            if at_least(middle) >= number:
                low = middle
            else:
                high = middle
    return values, vectors


def _start(a: np.ndarray, shift: float, others: np.ndarray, seed: int) -> np.ndarray:
    """Two steps of inverse iteration at a shift between the bounds."""
    v = np.random.default_rng(seed).standard_normal(len(a))
    for _ in range(2):
        v = _across(_solved(a, shift, _across(v, others)), others)
    return v


def rayleigh(a: np.ndarray, v: np.ndarray, others: np.ndarray, tight: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from v until its residual is rounding noise."""
    value = float(v @ a @ v)
    for _ in range(12):
        if float(np.linalg.norm(a @ v - value * v)) <= tight / 8:
            break
        v = _across(_solved(a, value, v), others)
        value = float(v @ a @ v)
    return value, v


def _solved(a: np.ndarray, shift: float, v: np.ndarray) -> np.ndarray:
    m = a - shift * np.eye(len(a))
    try:
        x = np.linalg.solve(m, v)
    except np.linalg.LinAlgError:
        x = None
    if x is None or not np.isfinite(x).all():  # the shift is an eigenvalue to the last bit
        step = max(float(np.abs(a).max()), np.finfo(float).tiny) * np.finfo(float).eps
        x = np.linalg.solve(m + step * np.diag(1 + np.arange(len(a)) / len(a)), v)
    return x / np.linalg.norm(x)


def _across(v: np.ndarray, others: np.ndarray) -> np.ndarray:
    """v at right angles to the other vectors, of length one."""
    for _ in range(2):
        v = v - others @ (others.T @ v)
    return v / np.linalg.norm(v)
