"""A symmetric eigendecomposition kept up to date under rank-one updates.

``Spectrum`` holds the scatter matrix of the vectors seen so far as eigenvalues and orthonormal eigenvectors, never as a
matrix. One more vector adds w * v v' (v is the vector less the mean): in the basis of the eigenvectors that is a
diagonal plus a rank-one term, whose eigenvalues are the roots of the secular equation

    1 + w * sum_j z_j^2 / (d_j - t) = 0,        z = Q' v,

one between each two neighbouring poles. Deflation comes first: a direction that v does not touch keeps its pair, and of
two (nearly) equal poles one is freed by a rotation. The eigenvectors come from the z that fits the roots exactly, which
keeps them orthogonal however close the roots are.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_STEPS = 80


def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """``d[j] - t[k]`` as row k and column j, for the roots t of 1 + sum z2 / (d - t): ``d`` rises strictly, ``z2`` > 0.

    A root is sought as its distance from the closer pole, so that differences to that pole keep all their digits. The
    step fits a pole on either side to value and slope of that side's sum; a step out of the bracket is a bisection.
    """
    k, total = len(d), z2.sum()
    right = np.append(d[1:], d[-1] + total)
    middle = (right - d) / 2
    near = d[None, :] - d[:, None]
    at_middle = 1 + (z2 / (near - middle[:, None])).sum(axis=1)
    to_left = at_middle >= 0
    to_left[-1] = True
    origin = np.where(to_left, d, right)
    poles = d[None, :] - origin[:, None]
    low = np.where(to_left, 0.0, -middle)
    high = np.where(to_left, np.append(middle[:-1], total), 0.0)
    low[-1] = 0.0 if at_middle[-1] >= 0 else middle[-1]
    high[-1] = middle[-1] if at_middle[-1] >= 0 else total
    t = (low + high) / 2
    own = np.arange(k)
    left_of = (own[:, None] >= own[None, :]).astype(float)
    sides = np.stack([left_of, 1 - left_of])
    last = k - 1
    for _ in range(_STEPS):
        gaps = poles - t[:, None]
        terms = z2 / gaps
        slopes = terms / gaps
        below, above = np.einsum("sij,ij->si", sides, terms)
        f = 1 + below + above
        done = np.abs(f) <= 8 * _EPS * (1 + np.abs(below) + above)
        low, high = np.where(f < 0, t, low), np.where(f > 0, t, high)
        done |= high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
        if done.all():
            break
        slope_below, slope_above = np.einsum("sij,ij->si", sides, slopes)
        a, b = gaps[own, own], gaps[own, np.minimum(own + 1, last)]
        with np.errstate(all="ignore"):
            c = f - a * slope_below - b * slope_above
            p = (a + b) * f - a * b * (slope_below + slope_above)
            q = a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            # The last root has no pole to its right.
            step[last] = a[last] + a[last] ** 2 * slope_below[last] / (1 + below[last] - a[last] * slope_below[last])
            new = t + step
        outside = ~(np.isfinite(new) & (new > low) & (new < high))
        t = np.where(done, t, np.where(outside, (low + high) / 2, new))
    return poles - t[:, None]


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and eigenvectors of ``q diag(d) q' + weight v v'`` for a weight above zero."""
    z = q.T @ v
    norm = float(np.sqrt(weight) * np.linalg.norm(z))
    if not norm:
        return d, q
    z = z * np.sqrt(weight)
    tolerance = 8 * _EPS * max(float(np.abs(d).max()), norm * norm)
    small = np.abs(z) * norm <= tolerance
    z[small] = 0
    active = np.flatnonzero(~small).tolist()
    kept, q = [], q.copy()
    for j in active:
        if kept:
            i = kept[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            if (d[j] - d[i]) * abs(c * s) <= tolerance:
                # Turn the pair so that only the second direction is touched; the first keeps its eigenvalue.
                q[:, [i, j]] = np.column_stack([c * q[:, i] - s * q[:, j], s * q[:, i] + c * q[:, j]])
                d[i], d[j] = d[i] * c * c + d[j] * s * s, d[i] * s * s + d[j] * c * c
                z[i], z[j] = 0, r
                kept.pop()
        kept.append(j)
    if not kept:
        return d, q
    at = np.array(kept)
    gaps = secular_roots(d[at], z[at] ** 2)
    own = np.arange(len(at))
    roots = d[at] - gaps[own, own]
    # z that has these roots to the last digit, by the product of the root's and the poles' distances.
    between = d[at][None, :] - d[at][:, None]
    np.fill_diagonal(between, 1.0)
    ratios = gaps / between
    fitted = np.sqrt(np.abs(np.prod(np.where(own[:, None] == own[None, :], -gaps, ratios), axis=0)))
    vectors = (np.copysign(fitted, z[at]) / gaps).T
    vectors /= np.linalg.norm(vectors, axis=0)
    values = d.copy()
    values[at] = roots
    q[:, at] = q[:, at] @ vectors
    order = np.argsort(values, kind="stable")
    return values[order], q[:, order]


class Spectrum:
    """Count, mean and the eigendecomposition of the centred scatter of vectors of ``size`` numbers."""

    def __init__(self, size: int) -> None:
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        """One vector: the scatter grows by n / (n + 1) times the square of its distance from the mean."""
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values.copy(), self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        """Another spectrum: a rank-one update for each of its pairs and one for the distance of the means."""
        if not other.n:
            return
        away, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values.copy(), self.vectors, vector, float(value))
        if self.n:
            self.values, self.vectors = rank_one(self.values.copy(), self.vectors, away, self.n * other.n / n)
        self.n, self.mean = n, self.mean + away * (other.n / n)
