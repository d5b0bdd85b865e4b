"""Leading eigenvalues and eigenvectors of a symmetric matrix.

Householder reflections make the matrix tridiagonal, bisection on Sturm counts finds the wanted eigenvalues, inverse
iteration finds their vectors, and vectors of close eigenvalues are made orthogonal to each other in every step.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
CLUSTER = 1e-3  # eigenvalues nearer than this share of the norm are treated as one cluster
STEPS = 8


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections, each with zeros in front."""
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        below = np.linalg.norm(x[1:])
        v = np.zeros(n)
        if below > 0:
            v[k + 1 :] = x
            v[k + 1] += np.copysign(np.hypot(x[0], below), x[0])
            v /= np.linalg.norm(v)
            p = a @ v
            w = p - v * (v @ p)
            a -= 2 * (np.outer(v, w) + np.outer(w, v))
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, tiny: float) -> np.ndarray:
    """Sturm count: how many eigenvalues are smaller than each shift."""
    q, count = np.ones(len(shifts)), np.zeros(len(shifts), int)
    for d, e2 in zip(diagonal, np.concatenate([[0.0], off**2])):
        q = d - shifts - e2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def largest(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by halving one interval each until it holds no number between its ends."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    slack = (max(abs(low), abs(high)) or 1.0) * 4 * EPS
    tiny = max(float(np.max(off**2, initial=0.0)), 1.0) * np.finfo(float).tiny
    lows, highs = np.full(k, low - slack), np.full(k, high + slack)
    place = n - np.arange(k)  # the j-th largest has n - j smaller ones or equals them
    while True:
        middle = (lows + highs) / 2
        if ((middle <= lows) | (middle >= highs)).all():
            return middle
        above = below(diagonal, off, middle, tiny) >= place
        highs, lows = np.where(above, middle, highs), np.where(above, lows, middle)


class Shifted:
    """The tridiagonal matrix less a shift, as triangular factors with row exchanges."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, shift: float, tiny: float):
        n = len(diagonal)
        self.d, self.u, self.uu = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
        self.factor, self.swapped = [0.0] * n, [False] * n
        d, u, uu = self.d, self.u, self.uu
        for i in range(n - 1):
            lower = float(off[i])
            if abs(d[i]) >= abs(lower):
                d[i] = d[i] if abs(d[i]) > tiny else tiny
                f = lower / d[i]
                d[i + 1] -= f * u[i]
            else:
                f = d[i] / lower
                d[i], u[i], d[i + 1] = lower, d[i + 1], u[i] - f * d[i + 1]
                uu[i] = u[i + 1]
                u[i + 1] = -f * u[i + 1]
                self.swapped[i] = True
            self.factor[i] = f
        d[-1] = d[-1] if abs(d[-1]) > tiny else tiny

    def solve(self, right: np.ndarray) -> np.ndarray:
        x, n = right.tolist(), len(self.d)
        for i in range(n - 1):
            if self.swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= self.factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            rest = x[i]
            if i + 1 < n:
                rest -= self.u[i] * x[i + 1]
            if i + 2 < n:
                rest -= self.uu[i] * x[i + 2]
            x[i] = rest / self.d[i]
        return np.array(x)


def orthogonal(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for y in others:
            x = x - y * (y @ x)
    return x / np.linalg.norm(x)


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors as columns; fewer if the matrix is smaller.

    Equal eigenvalues give orthogonal vectors of their common space. The same matrix gives the same result.
    """
    n = len(matrix)
    k = min(k, n)
    if not k:
        return np.zeros(0), np.zeros((n, 0))
    scale = float(np.abs(matrix).max())
    if scale == 0:
        return np.zeros(k), np.eye(n, k)
    diagonal, off, reflections = tridiagonal(np.asarray(matrix, float) / scale)
    values = largest(diagonal, off, k)
    norm = float((np.abs(diagonal) + np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))).max())
    random = np.random.default_rng(0)
    vectors: list[np.ndarray] = []
    cluster = shift = 0
    for j, value in enumerate(values):
        if j == 0 or values[j - 1] - value >= CLUSTER * norm:
            cluster, shift = j, value
        else:
            shift = min(value, shift - 4 * EPS * norm)  # equal shifts would solve the same system again
        solver = Shifted(diagonal, off, float(shift), EPS * norm)
        x = orthogonal(random.standard_normal(n), vectors[cluster:])
        for _ in range(STEPS):
            y = solver.solve(x)
            x = orthogonal(y / np.abs(y).max(), vectors[cluster:])
        vectors.append(x)
    columns = np.array(vectors).T
    for v in reversed(reflections):
        columns -= 2 * np.outer(v, v @ columns)
    return values * scale, columns
