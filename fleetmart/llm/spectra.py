"""Eigendecompositions that grow by rank-one updates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EPS = np.finfo(np.float64).eps
_ROUNDS = 60


def _secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)), one above each d: (index of a pole, offset from it).

    ``d`` rises strictly and no ``z2`` is 0, so root i lies between d[i] and d[i + 1], the last
    one below d[-1] + rho * sum(z2). Offsets are from the nearer pole, to full relative
    accuracy. Steps fit one pole on either side to the sums below and above the root; a step
    that leaves its bracket is replaced by half of the bracket.
    """
    m = len(d)
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    if m == 1:
        return np.zeros(1, dtype=np.int64), rho * z2
    gap = upper - d
    at = np.arange(m)
    middle = d[None, :] - d[:, None] - gap[:, None] / 2
    left = 1.0 / rho + (z2 / middle).sum(axis=1) >= 0
    left[-1] = True
    origin = np.where(left, at, np.minimum(at + 1, m - 1))
    poles = d[None, :] - d[origin][:, None]
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, gap / 2, 0.0)
    high[-1] = gap[-1]
    y = (low + high) / 2
    first, second = np.minimum(at, m - 2), np.minimum(at + 1, m - 1)
    near, far = poles[at, first], poles[at, second]
    mask = np.tri(m)
    mask[-1, -1] = 0.0  # the last root lies above all poles and fits the last two
    for _ in range(_ROUNDS):
        inverse = 1.0 / (poles - y[:, None])
        square = inverse * inverse
        f_down, down = (inverse * mask) @ z2, (square * mask) @ z2
        f_all, all_ = inverse @ z2, square @ z2
        f = 1.0 / rho + f_all
        low, high = np.where(f < 0, y, low), np.where(f < 0, high, y)
        # Terms of poles below a root are negative, those above it positive.
        error = 16 * _EPS * (1.0 / rho + np.abs(f_down) + np.abs(f_all - f_down))
        done = (np.abs(f) <= error) | (high - low <= 2 * _EPS * np.abs(y))
        if done.all():
            break
        a1, a2 = near - y, far - y
        c = f - a1 * down - a2 * (all_ - down)
        a = (a1 + a2) * f - a1 * a2 * all_
        b = a1 * a2 * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(all="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = (a[-1] + root[-1]) / (2 * c[-1]) if a[-1] >= 0 else 2 * b[-1] / (a[-1] - root[-1])
        new = y + step
        inside = (new > low) & (new < high)
        y = np.where(done, y, np.where(inside, new, (low + high) / 2))
    return origin, y


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors of u @ diag(d) @ u.T + rho * outer(v, v), rho > 0.

    Deflation comes first: a component of ``v`` along an eigenvector that is too small to
    matter leaves that pair as it is; of two equal eigenvalues, a rotation of their vectors
    frees one. The others move to the roots of the secular equation, and their vectors follow
    from weights recomputed for those roots, which keeps them orthogonal.
    """
    z = v @ u
    norm2 = float(z @ z)
    if norm2 == 0.0 or rho == 0.0:
        return d, u
    size = max(float(np.abs(d).max()), rho * norm2)
    small = 8 * _EPS * size
    order = np.argsort(d, kind="stable")
    d, u, z = d[order], u[:, order], z[order]
    moves = rho * np.abs(z) * np.sqrt(norm2) > small
    held = np.flatnonzero(moves)
    if len(held) > 1 and (np.diff(d[held]) <= small).any():
        u = u.copy()
        last = held[0]
        for j in held[1:]:
            if d[j] - d[last] <= small:
                r = np.hypot(z[last], z[j])
                c, s = z[j] / r, z[last] / r
                u[:, last], u[:, j] = c * u[:, last] - s * u[:, j], s * u[:, last] + c * u[:, j]
                z[last], z[j], moves[last] = 0.0, r, False
            last = j
        held = np.flatnonzero(moves)
    if not len(held):
        return d, u
    dk, zk = d[held], z[held]
    origin, offset = _secular_roots(dk, zk * zk, rho)
    # gaps[i, j] = root i - d[j], without cancellation near the pole it was found from.
    gaps = (dk[origin][:, None] - dk[None, :]) + offset[:, None]
    gaps = np.where(gaps == 0, np.finfo(np.float64).tiny, gaps)
    m = len(held)
    # Weight j: roots below d[j] over the poles below it, roots above over the poles above.
    pole = np.where(np.tri(m, k=-1, dtype=bool).T, dk[:, None], np.append(dk[1:], np.inf)[:, None])
    ratio = gaps / (pole - dk)
    ratio[-1] = gaps[-1]
    weight = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.where(zk < 0, -1.0, 1.0)
    vectors = weight[:, None] / -gaps.T
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    out_d, out_u = d.copy(), u.copy()
    out_d[held] = dk[origin] + offset
    out_u[:, held] = u[:, held] @ vectors
    order = np.argsort(out_d, kind="stable")
    return out_d[order], out_u[:, order]


@dataclass
class Spectrum:
    """``n`` vectors, their mean, and the eigendecomposition of their centred scatter."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(width: int) -> Spectrum:
        return Spectrum(0, np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, x: np.ndarray) -> None:
        """One more vector: the scatter grows by its centred outer product."""
        away = x - self.mean
        if self.n:
            weight = self.n / (self.n + 1)
            self.values, self.vectors = rank_one(self.values, self.vectors, away, weight)
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        """The other's scatter, one eigenpair after the other, and the step between the means."""
        if not other.n:
            return
        least = _EPS * max(float(other.values.max(initial=0.0)), 0.0)
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > least:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        if self.n:
            away = other.mean - self.mean
            weight = self.n * other.n / (self.n + other.n)
            self.values, self.vectors = rank_one(self.values, self.vectors, away, weight)
            self.mean = self.mean + away * (other.n / (self.n + other.n))
        else:
            self.mean = other.mean
        self.n += other.n
