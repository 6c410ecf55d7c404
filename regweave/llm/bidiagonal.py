"""Singular values and right singular vectors of a small square matrix.

Householder reflections make the matrix bidiagonal; differential quotient-difference sweeps
with shifts (dqds) find all singular values to high relative accuracy; a factorisation twisted
where its pivot is least gives a vector for each of the largest. Only sizes of a vector's
dimensions come here, never rows of data.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Neighbours closer than this share of their value are made orthogonal by hand.
CLUSTER = 1e-3


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a and superdiagonal b of U'RW, and W."""
    r = np.array(r, dtype=float)
    n = len(r)
    w = np.eye(n)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        """The reflection's unit normal that leaves only x[0]."""
        length = np.linalg.norm(x)
        if not length or not np.any(x[1:]):
            return None
        v = x / length
        v[0] += 1.0 if v[0] >= 0 else -1.0
        return v / np.linalg.norm(v)

    for k in range(n - 1):
        v = mirror(r[k:, k])
        if v is not None:
            r[k:, k:] -= 2 * np.outer(v, v @ r[k:, k:])
        v = mirror(r[k, k + 1:])
        if v is not None:
            r[k:, k + 1:] -= 2 * np.outer(r[k:, k + 1:] @ v, v)
            w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(r).copy(), np.diag(r, 1).copy(), w


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transform: q and e of the shifted matrix, and the d of every step."""
    d = q[0] - shift
    new_q, new_e, seen = [], [], [d]
    for k in range(len(e)):
        top = d + e[k]
        new_q.append(top)
        if top == 0.0:  # a row of zeros: the rest stands alone
            new_e.append(0.0)
            d = q[k + 1] - shift
        else:
            ratio = q[k + 1] / top
            new_e.append(e[k] * ratio)
            d = d * ratio - shift
        seen.append(d)
    new_q.append(d)
    return new_q, new_e, seen


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared singular values of the upper bidiagonal matrix with a and b, falling.

    A sweep without shift tells 1 / sum(1 / d), which is below the least value; the next one
    is shifted by that, and the last off-diagonal entry vanishes in a few rounds.
    """
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(len(a))
    q, e = ((x / scale) ** 2 for x in (np.asarray(a), np.asarray(b)))
    q, e = q.tolist(), e.tolist()
    sigma, found, least = 0.0, [], (100 * EPS) ** 2
    rounds = 0
    while q:
        m = len(q)
        if m == 1 or e[-1] <= least * (sigma + q[-1]) or e[-1] < np.finfo(float).tiny:
            found.append(sigma + q.pop())
            del e[m - 2:]
            continue
        rounds += 1
        if rounds > 100 * len(a) + 100:
            raise ArithmeticError("the qd sweeps do not converge")
        if q[0] * 1.5 < q[-1]:  # the least value is found last, where it stands last
            q, e = q[::-1], e[::-1]
        q, e, seen = _sweep(q, e, 0.0)
        if min(seen) <= 0.0:  # a zero value
            continue
        shift = (1.0 - 4 * m * EPS) / sum(1.0 / d for d in seen)
        if not sigma + shift > sigma:
            continue
        new_q, new_e, seen = _sweep(q, e, shift)
        if min(seen) >= 0.0:
            q, e, sigma = new_q, new_e, sigma + shift
    return np.sort(np.array(found))[::-1] * scale ** 2


def _twisted(q: np.ndarray, e: np.ndarray, off: np.ndarray, value: float) -> np.ndarray:
    """The vector of B'B for an eigenvalue: from the top and from the bottom to the least pivot."""
    n = len(q)
    tiny = EPS * EPS * max(value, np.finfo(float).tiny)
    top, bottom = np.zeros(n), np.zeros(n)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):
        top[k] = s[k] + q[k] or tiny
        s[k + 1] = e[k] * (s[k] / top[k]) - value
    p[n - 1] = q[n - 1] - value
    for k in range(n - 2, -1, -1):
        bottom[k + 1] = e[k] + p[k + 1] or tiny
        p[k] = p[k + 1] * (q[k] / bottom[k + 1]) - value
    r = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -off[k] / top[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -off[k] / bottom[k + 1] * z[k]
    return z / np.linalg.norm(z)


def _solved(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """A symmetric tridiagonal system, with exchanged rows where that keeps pivots large; none is below tiny."""
    n = len(diagonal)
    rows = np.zeros((n, 4))  # three diagonals from the pivot on, and the right side
    rows[:, 0], rows[:, 3] = diagonal, x
    rows[:-1, 1] = off
    for k in range(n - 1):
        below = np.array([off[k], diagonal[k + 1], off[k + 1] if k + 2 < n else 0.0, rows[k + 1, 3]])
        if abs(below[0]) > abs(rows[k, 0]):
            rows[k], below = below, rows[k].copy()
        factor = below[0] / (rows[k, 0] or tiny)
        rows[k + 1, :3] = below[1] - factor * rows[k, 1], below[2] - factor * rows[k, 2], 0.0
        rows[k + 1, 3] = below[3] - factor * rows[k, 3]
    z = np.zeros(n + 2)
    for k in range(n - 1, -1, -1):
        pivot = rows[k, 0] if abs(rows[k, 0]) > tiny else tiny
        z[k] = (rows[k, 3] - rows[k, 1] * z[k + 1] - rows[k, 2] * z[k + 2]) / pivot
    return z[:n]


def largest(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of a square matrix, falling, and right singular vectors
    (columns) of the first `count` that are not zero beside the largest."""
    n = len(r)
    if not n:
        return np.zeros(0), np.zeros((0, 0))
    a, b, w = bidiagonal(r)
    values = squared_values(a, b)
    rank = int(np.sum(values > (n * EPS) ** 2 * values[0])) if values[0] > 0 else 0
    q, e, off = a * a, b * b, a[:-1] * b
    diagonal = q + np.concatenate([[0.0], e])
    vectors: list[np.ndarray] = []
    for k in range(min(count, rank)):
        z = _twisted(q, e, off, values[k])
        close = [vectors[j] for j in range(k) if values[j] - values[k] <= CLUSTER * values[j]]
        if close:
            rest = z - sum(x * (x @ z) for x in close)
            if np.linalg.norm(rest) < 0.5:  # the same direction again
                rest = np.random.default_rng(k).standard_normal(n)
            for _ in range(4):
                rest -= sum(x * (x @ rest) for x in close)
                rest /= np.linalg.norm(rest)
                rest = _solved(diagonal - values[k], off, rest, EPS * values[0])
                rest /= np.linalg.norm(rest)
            rest -= sum(x * (x @ rest) for x in close)
            z = rest / np.linalg.norm(rest)
        vectors.append(z)
    return values, w @ np.array(vectors).T if vectors else np.zeros((n, 0))
