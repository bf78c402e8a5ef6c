"""A symmetric eigendecomposition kept up to date under rank-one updates (numpy, one spectrum at a time).

``Spectrum`` holds the count, the mean and the scatter matrix of the vectors seen, the latter as eigenvalues and orthonormal
eigenvectors of its range. Adding a vector, or another spectrum, is a sequence of updates A + rho v v', each solved through the
secular equation 1 + rho * sum(z_i^2 / (d_i - x)) = 0 after deflation of components that an update leaves alone.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Steps of the root finder; a handful are needed.
STEPS = 80


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """gap[j, i] = (root j) - d[i], for rising distinct ``d``, nonzero ``z`` and positive ``rho``.

    Root j lies between d[j] and d[j + 1] (the last one below d[-1] + rho |z|^2). Each is found as a distance from the nearer pole,
    by a two-pole rational fit of the equation, kept inside a bracket by bisection.
    """
    m, w = len(d), rho * z * z
    if m == 1:
        return w.reshape(1, 1).copy()
    right = np.append(d[1:], d[-1] + w.sum())
    middle = 0.5 * (d + right)
    at_middle = 1.0 + (w / (d - middle[:, None])).sum(1)
    near = np.arange(m)
    near[:-1] += at_middle[:-1] < 0                     # the root is in the upper half: measure from the pole above
    origin = d[near]
    pole = d - origin[:, None]                          # pole[j, i] = d[i] - origin of root j
    left, top = d - origin, right - origin
    low, high = left.copy(), top.copy()
    half = 0.5 * (left + top)
    upper = at_middle < 0
    low[upper], high[~upper] = half[upper], half[~upper]
    x = 0.5 * (low + high)
    below = np.tri(m)                                   # poles up to the root's own
    above = 1.0 - below
    last = np.arange(m) == m - 1
    for _ in range(STEPS):
        gap = pole - x[:, None]
        term = w / gap
        slope = term / gap
        psi, dpsi = np.einsum("ji,ji->j", term, below), np.einsum("ji,ji->j", slope, below)
        phi, dphi = np.einsum("ji,ji->j", term, above), np.einsum("ji,ji->j", slope, above)
        f = 1.0 + psi + phi
        low, high = np.where(f < 0, x, low), np.where(f > 0, x, high)
        done = np.abs(f) <= 4 * EPS * (1.0 + np.abs(psi) + np.abs(phi)) * m
        a, b = left - x, top - x
        s, t = dpsi * a * a, np.where(last, 0.0, dphi * b * b)
        c = f - dpsi * a - np.where(last, 0.0, dphi * b)
        # c (a - y)(b - y) + s (b - y) + t (a - y) = 0 for the step y; the last root has one pole only
        q1, q0 = c * (a + b) + s + t, c * a * b + s * b + t * a
        root = np.sqrt(np.maximum(q1 * q1 - 4 * c * q0, 0.0))
        with np.errstate(all="ignore"):
            y = np.where(q1 > 0, 2 * q0 / (q1 + root), (q1 - root) / (2 * c))
            y = np.where(last, a + s / c, y)
        new = x + y
        out = ~((new > low) & (new < high))
        new[out] = 0.5 * (low[out] + high[out])
        still = ~done & (np.abs(new - x) > 2 * EPS * np.abs(x))
        if not still.any():
            break
        x = np.where(done, x, new)
    return x[:, None] - pole


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of U diag(values) U' + rho v v', rho > 0, on the span of U and v."""
    z = vectors.T @ v
    rest = v - vectors @ z
    again = vectors.T @ rest                            # a second pass keeps the columns orthogonal
    z, rest = z + again, rest - vectors @ again
    size, outside = float(np.sqrt(v @ v)), float(np.sqrt(rest @ rest))
    if size == 0.0:
        return values, vectors
    if len(values) < len(v) and outside > 64 * EPS * size:
        values = np.concatenate([[0.0], values])
        vectors = np.column_stack([rest / outside, vectors])
        z = np.concatenate([[outside], z])
        order = np.argsort(values, kind="stable")
        values, vectors, z = values[order], vectors[:, order], z[order]
    scale = max(float(values[-1]) if len(values) else 0.0, rho * size * size)
    tiny = 8 * EPS * scale
    # equal eigenvalues: a reflection of their eigenvectors gathers the update in one of them
    close = np.diff(values) <= tiny
    if close.any():
        vectors, edges = vectors.copy(), np.flatnonzero(np.concatenate([[True], ~close, [True]]))
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            own = z[a:b].copy()
            length = float(np.sqrt(own @ own))
            if b - a > 1 and length > 0.0:
                u = own.copy()
                u[-1] += length if u[-1] >= 0 else -length
                block = vectors[:, a:b]
                vectors[:, a:b] = block - np.outer(block @ u, u) * (2.0 / (u @ u))
                z[a:b] = 0.0
                z[b - 1] = -length if own[-1] >= 0 else length
    # components that the update hardly touches stay as they are
    moved = np.flatnonzero(rho * np.abs(z) * size > tiny)
    if not len(moved):
        return values, vectors
    d, y = values[moved], z[moved]
    gap = secular_roots(d, y, rho)
    m = len(d)
    # weights for which the roots are exact: their eigenvectors are orthogonal to working precision
    poles = d[None, :] - d[:, None]                     # poles[i, j] = d[j] - d[i]
    shifted = np.empty((m, m))
    shifted[:-1] = np.where(np.tri(m - 1, m, 0, dtype=bool), poles.T[1:], poles.T[:-1])
    shifted[-1] = rho
    with np.errstate(all="ignore"):
        own = np.sqrt(np.abs(np.prod(gap / shifted, axis=0)))
        own = np.where(np.isfinite(own) & (own > 0), own, np.abs(y)) * np.where(y < 0, -1.0, 1.0)
        turn = own[:, None] / gap.T                     # column j: eigenvector of root j
    turn = np.where(np.isfinite(turn), turn, np.sign(turn) * 1e300 if not np.isnan(turn).any() else 0.0)
    turn /= np.sqrt((turn * turn).sum(0))
    values, vectors = values.copy(), vectors.copy()
    values[moved] = d[np.minimum(np.arange(m), m - 1)] + np.diagonal(gap)
    vectors[:, moved] = vectors[:, moved] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    def __init__(self, dims: int):
        self.n, self.mean = 0, np.zeros(dims)
        self.values, self.vectors = np.empty(0), np.empty((dims, 0))

    def add(self, x: np.ndarray) -> None:
        """One more vector: the scatter grows by n / (n + 1) times the square of its distance from the mean."""
        off = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1.0))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: "Spectrum") -> None:
        """Another spectrum's vectors: one update per eigenvector, and one for the distance of the means."""
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        for k in range(len(other.values)):
            if other.values[k] > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, other.vectors[:, k], float(other.values[k]))
        n, off = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / n)
        self.n, self.mean = n, self.mean + off * (other.n / n)
