"""Singular values and right singular vectors of a small square matrix, by way of a bidiagonal one.

Householder reflections make the matrix upper bidiagonal, differential quotient-difference steps with shifts (dqds)
find its singular values, each to high relative accuracy, and twisted factorisations give the vectors.  Memory is a few
copies of the matrix, which has a row and a column for each dimension of the data and never grows with their number.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
#: Neighbouring eigenvalues that are relatively closer than this are one cluster, whose vectors are made orthogonal.
CLOSE = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and tau such that ``x - tau * v * (v @ x)`` is zero but for its first entry."""
    v = x.copy()
    size = math.sqrt(float(x @ x))
    if size == 0.0 or not np.any(x[1:]):
        return v, 0.0
    v[0] += math.copysign(size, x[0])
    return v, 2.0 / float(v @ v)


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the orthogonal V of ``matrix = U B V'``."""
    rest = np.array(matrix, dtype=float)
    n = len(rest)
    right = np.eye(n)
    for k in range(n):
        v, tau = _reflector(rest[k:, k])
        rest[k:, k:] -= np.outer(tau * v, v @ rest[k:, k:])
        if k < n - 2:
            v, tau = _reflector(rest[k, k + 1 :])
            rest[k:, k + 1 :] -= np.outer(rest[k:, k + 1 :] @ v, tau * v)
            right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, tau * v)
    return np.diagonal(rest).copy(), np.diagonal(rest, 1).copy(), right


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transform: new q, new e, and the d of every row (one below zero: the shift was too large)."""
    out_q, out_e, ds = [], [], []
    d = q[0] - shift
    for i in range(len(e)):
        ds.append(d)
        total = d + e[i]
        out_q.append(total)
        ratio = q[i + 1] / total if total != 0.0 else 0.0
        out_e.append(e[i] * ratio)
        d = d * ratio - shift
    ds.append(d)
    out_q.append(d)
    return out_q, out_e, ds


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squares of the singular values of an upper bidiagonal matrix, falling, by dqds.

    The shift of each step is the harmonic bound 1 / sum(1 / d) of a step without shift, which never lies above the
    smallest eigenvalue; a step that rounding turns negative is repeated with less of it.
    """
    scale = max(float(np.max(np.abs(diagonal), initial=0.0)), float(np.max(np.abs(above), initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    open_parts = [([float(x) ** 2 for x in diagonal / scale], [float(x) ** 2 for x in above / scale], 0.0)]
    negligible = (4 * EPS) ** 2
    while open_parts:
        q, e, base = open_parts.pop()
        while len(q) > 1:
            cut = next((i for i, x in enumerate(e) if x <= negligible * (base + min(q[i], q[i + 1]))), None)
            if cut is not None:
                open_parts.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # large values first: small ones settle at the end
                q, e = q[::-1], e[::-1]
            plain = _step(q, e, 0.0)
            if min(plain[2]) <= negligible * max(plain[0]):
                q, e = plain[0], plain[1]
                q[-1] = max(q[-1], 0.0)
                if q[-1] <= negligible * max(q):  # a singular value of zero
                    found.append(base)
                    q, e = q[:-1], e[:-1]
                continue
            shift = (1.0 - 8 * EPS) / sum(1.0 / d for d in plain[2])
            moved = _step(q, e, shift)
            while min(moved[2]) < 0.0 and shift > 0.0:
                shift = shift * 0.75 if shift > EPS * base else 0.0
                moved = _step(q, e, shift)
            q, e, base = moved[0], moved[1], base + shift
        if q:
            found.append(base + max(q[0], 0.0))
    return np.sort(np.array(found))[::-1] * scale**2


class _Twisted:
    """The twisted factorisation of ``B'B - value`` at the row where it is closest to singular."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float) -> None:
        n = len(diagonal)
        q, e, cross = diagonal**2, above**2, diagonal[: n - 1] * above
        tiny = EPS * EPS * max(float(q.max()), 1e-300)

        def sound(x: float) -> float:
            return x if abs(x) > tiny else math.copysign(tiny, x)

        s, p = np.empty(n), np.empty(n)
        self.down, self.up = np.empty(n), np.empty(n)  # pivots from the top and from the bottom
        self.lower, self.upper = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
        s[0] = -value
        for i in range(n - 1):
            self.down[i] = sound(q[i] + s[i])
            self.lower[i] = cross[i] / self.down[i]
            s[i + 1] = e[i] / self.down[i] * s[i] - value
        self.down[n - 1] = sound(q[n - 1] + s[n - 1])
        p[n - 1] = q[n - 1] - value
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = sound(e[i] + p[i + 1])
            self.upper[i] = cross[i] / self.up[i + 1]
            p[i] = p[i + 1] * (q[i] / self.up[i + 1]) - value
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.gamma = sound(float(gamma[self.at]))

    def solved(self, b: np.ndarray) -> np.ndarray:
        n, k = len(b), self.at
        y = b.copy()
        for i in range(k):
            y[i + 1] -= self.lower[i] * y[i]
        bottom = 0.0
        for i in range(n - 2, k - 1, -1):
            if i == k:
                bottom = self.upper[i] * y[i + 1]
            else:
                y[i] -= self.upper[i] * y[i + 1]
        y[k] -= bottom
        y[:k] /= self.down[:k]
        y[k + 1 :] /= self.up[k + 1 :]
        y[k] /= self.gamma
        return self._backward(y)

    def vector(self) -> np.ndarray:
        y = np.zeros(len(self.down))
        y[self.at] = 1.0
        return self._backward(y)

    def _backward(self, y: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        for i in range(self.at, len(y) - 1):
            y[i + 1] -= self.upper[i] * y[i]
        return y / np.linalg.norm(y)


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One column per value (falling squares of singular values): the right singular vector of the bidiagonal matrix.

    Vectors of a cluster are found by inverse iteration with the twisted factors, each kept orthogonal to those before.
    """
    scale = float(max(np.max(np.abs(diagonal)), np.max(np.abs(above), initial=0.0), 1e-300))
    diagonal, above, values = diagonal / scale, above / scale, values / scale**2
    columns: list[np.ndarray] = []
    cluster = 0  # the first column of the present cluster
    draw = np.random.default_rng(1)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * values[j - 1]:
            cluster = j
        near = columns[cluster:j]
        factors = _Twisted(diagonal, above, float(value))
        z = factors.vector()
        if near:
            block = np.array(near)
            if j and values[j - 1] - value <= 10 * EPS * values[j - 1]:
                z = draw.standard_normal(len(diagonal))
            for _ in range(4):
                for _ in range(2):
                    z = z - block.T @ (block @ z)
                z = factors.solved(z / np.linalg.norm(z))
            for _ in range(2):
                z = z - block.T @ (block @ z)
                z = z / np.linalg.norm(z)
        columns.append(z)
    return np.array(columns).T.reshape(len(diagonal), len(columns))


def principal(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest squared singular values of a square matrix and their right vectors as columns.

    Values that rounding cannot tell from zero are left out.
    """
    diagonal, above, right = bidiagonalised(matrix)
    values = squared_singular_values(diagonal, above)
    if not len(values) or values[0] <= 0.0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    least = values[0] * (8 * len(values) * EPS) ** 2
    kept = values[: int(np.count_nonzero(values[:most] > least))]
    vectors = right @ right_vectors(diagonal, above, kept)
    return kept, vectors / np.linalg.norm(vectors, axis=0)
