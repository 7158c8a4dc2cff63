"""Singular values and right singular vectors of a small triangular matrix, by way of its bidiagonal form."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
NEGLIGIBLE = (10 * EPS) ** 2
MAX_SWEEPS = 200  # per singular value; a handful is usual
CLUSTER = 1e-3  # relative gap below which directions are kept apart by orthogonalisation
ROUNDS = 4  # inverse iterations within a cluster


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vector ``u`` and number ``alpha``: ``x - 2 u (u.x)`` is ``alpha`` times the first unit vector."""
    alpha = -np.copysign(np.linalg.norm(x), x[0])
    u = x.copy()
    u[0] -= alpha
    size = np.linalg.norm(u)
    return (u / size, alpha) if size else (u, alpha)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and ``v`` with ``r = u b v.T``, by Householder reflections from both sides."""
    m = r.astype(float).copy()
    d = len(m)
    v = np.eye(d)
    diagonal, upper = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        u, diagonal[k] = _reflector(m[k:, k])
        m[k:, k:] -= 2 * np.outer(u, u @ m[k:, k:])
        if k + 1 < d:
            u, upper[k] = _reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return diagonal, upper, v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential quotient-difference transform with shift: new ``q`` and ``e``, and the ``d`` on the way.

    None if the shift exceeds the smallest eigenvalue.
    """
    d = q[0] - shift
    new_q, new_e, way = [], [], [d]
    for i in range(len(e)):
        if d < 0:
            return None
        total = d + e[i]
        new_q.append(total)
        ratio = q[i + 1] / total if total else 0.0
        new_e.append(e[i] * ratio)
        d = (d * ratio if total else q[i + 1]) - shift
        way.append(d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, way


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values, rising, by dqds.

    Each value is found from below: a transform without shift yields the diagonal of the inverse, and one over its
    sum is a shift that never passes the smallest eigenvalue and comes close to it as others fall behind.
    """
    scale = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    if not scale:
        return np.zeros(len(diagonal))
    # Zeros on the diagonal are lifted to what rounding cannot tell from zero.
    least = (EPS * scale) ** 2 * EPS
    work = [([max(x, least) for x in (diagonal**2).tolist()], (upper**2).tolist(), 0.0)]
    found: list[float] = []
    while work:
        q, e, base = work.pop()
        for _ in range(MAX_SWEEPS * len(q)):
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= NEGLIGIBLE * (base + min(q[i], q[i + 1]))), None)
            if cut is not None:
                work += [(q[: cut + 1], e[:cut], base), (q[cut + 1 :], e[cut + 1 :], base)]
                break
            if len(q) == 1:
                found.append(base + q[0])
                break
            q, e, way = _sweep(q, e, 0.0)
            shift = 0.0 if min(way) <= 0 else 1 / sum(1 / d for d in way)
            while shift > 0:
                moved = _sweep(q, e, shift)
                if moved is not None:
                    q, e, _ = moved
                    base += shift
                    break
                shift *= 0.75  # only rounding leads here
                if shift < EPS * base:
                    break
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(found)


class Twisted:
    """Factorisation of ``b.T b - value`` from both ends, joined where its pivot is smallest."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, value: float) -> None:
        d = len(diagonal)
        tiny = EPS * max(value, np.finfo(float).tiny / EPS)
        floor = EPS * np.abs(diagonal).max(initial=0) + np.finfo(float).tiny
        a = np.where(np.abs(diagonal) < floor * EPS, floor * EPS, diagonal)
        pivots, factors = a * a, upper / a[:-1]
        down, lower, s = np.zeros(d), np.zeros(d - 1), np.zeros(d)
        s[0] = -value
        for i in range(d):
            down[i] = s[i] + pivots[i]
            if i + 1 < d:
                if not down[i]:  # a pivot of zero is moved by rounding
                    s[i], down[i] = s[i] + tiny, tiny
                lower[i] = pivots[i] * factors[i] / down[i]
                s[i + 1] = lower[i] * factors[i] * s[i] - value
        up, rising, p = np.zeros(d), np.zeros(d - 1), np.zeros(d)
        p[-1] = pivots[-1] - value
        for i in range(d - 2, -1, -1):
            up[i + 1] = pivots[i] * factors[i] ** 2 + p[i + 1]
            if not up[i + 1]:
                p[i + 1], up[i + 1] = p[i + 1] + tiny, tiny
            t = pivots[i] / up[i + 1]
            rising[i] = factors[i] * t
            p[i] = p[i + 1] * t - value
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.lower, self.rising = lower, rising
        self.pivots = np.concatenate([down[: self.at], [gamma[self.at] or tiny], up[self.at + 1 :]])

    def vector(self) -> np.ndarray:
        """The eigenvector: the solution for the unit vector at the twist."""
        z = np.zeros(len(self.pivots))
        z[self.at] = 1
        return self._back(z)

    def solve(self, v: np.ndarray) -> np.ndarray:
        w, at = v.copy(), self.at
        for i in range(at):
            w[i + 1] -= self.lower[i] * w[i]
        for i in range(len(w) - 1, at, -1):
            w[i - 1] -= self.rising[i - 1] * w[i]
        return self._back(w / self.pivots)

    def _back(self, z: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.lower[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.rising[i] * z[i]
        return z / np.linalg.norm(z)


def _directions(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of ``b.T b``, a column for each of the falling ``values``."""
    out = np.zeros((len(diagonal), len(values)))
    start = 0
    chance = np.random.default_rng(0)
    for j, value in enumerate(values.tolist()):
        if j and values[j - 1] - value > CLUSTER * values[j - 1]:
            start = j
        factors = Twisted(diagonal, upper, value)
        clustered = start < j or (j + 1 < len(values) and value - values[j + 1] <= CLUSTER * value)
        z = factors.vector() if not clustered else chance.standard_normal(len(diagonal))
        for _ in range(ROUNDS if clustered else 0):
            near = out[:, start:j]
            z = factors.solve(z - near @ (near.T @ z))
            z -= near @ (near.T @ z)
            z /= np.linalg.norm(z)
        out[:, j] = z
    return out


def leading_directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest squared singular values of ``r``, falling, and the right singular vectors as columns.

    Values that rounding cannot tell from zero are left out. The largest component of a vector is positive.
    """
    if not np.abs(r).max(initial=0):
        return np.zeros(0), np.zeros((len(r), 0))
    diagonal, upper, v = bidiagonalise(r)
    values = squared_singular_values(diagonal, upper)[::-1]
    values = values[values > values[0] * (EPS * len(r)) ** 2][:most]
    vectors = v @ _directions(diagonal, upper, values)
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[largest, np.arange(len(values))])
