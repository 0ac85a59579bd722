"""Singular values and right singular vectors of a small triangular matrix, to double precision.

Householder reflections make the matrix upper bidiagonal. The quotient-difference algorithm with
shifts, in its differential form (dqds), finds the singular values of the bidiagonal: it only ever
multiplies, divides and adds positive numbers, so small values are as accurate as large ones. A
right singular vector is an eigenvector of B'B = L D L'. For its value the factorisation of
L D L' - value is run from the top (stationary qd) and from the bottom (progressive qd), and the
two are joined, twisted, where the joint pivot is least; the vector follows by multiplications.
Vectors of values that lie close together are solved for by inverse iteration on the same
twisted factors and kept at right angles to each other.

All matrices here are as wide as the vectors of the data, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
# Values nearer than this, relative to the larger one, form a cluster.
CLUSTER = 1e-3
# Part of its neighbour below which the square of a superdiagonal entry counts as zero.
NEGLIGIBLE = (10 * EPS) ** 2
TINY = float(np.finfo(float).tiny)


def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' a V, and V, for a square matrix ``a``."""
    a = np.array(a, float)
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        column = a[k:, k]
        w, beta = reflector(column)
        a[k:, k:] -= beta * np.outer(w, w @ a[k:, k:])
        if k + 2 < n:
            w, beta = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """w and beta such that x - beta w (w'x) is zero but for its first entry."""
    w, norm = x.astype(float).copy(), float(np.linalg.norm(x))
    if norm == 0 or len(x) == 1:
        return w, 0.0
    w[0] += norm if w[0] >= 0 else -norm
    return w, 2.0 / float(w @ w)


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transform: new q and e, and the d before each new q."""
    n = len(q)
    new_q, new_e, seen = [0.0] * n, [0.0] * (n - 1), [0.0] * n
    d = q[0] - shift
    for i in range(n - 1):
        seen[i] = d
        top = d + e[i]
        new_q[i] = top
        if top == 0.0:
            new_e[i], d = 0.0, q[i + 1] - shift
            continue
        ratio = q[i + 1] / top
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
        if seen[i] < 0:
            break
    else:
        seen[n - 1] = d
    new_q[n - 1] = d
    return new_q, new_e, seen


def _last_pair(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last 2 x 2 block of B'B."""
    b = q[-1] + e[-1]
    a = q[-2] + (e[-2] if len(e) > 1 else 0.0)
    c2 = q[-2] * e[-1]
    half = (a - b) / 2
    root = (half * half + c2) ** 0.5
    low = (a + b) / 2 - root
    return low if low > 0 else 0.0


def singular_values_squared(diagonal: np.ndarray, above: np.ndarray) -> list[float]:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    out: list[float] = []
    work = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while work:
        q, e, sigma = work.pop()
        guess, sweeps, most = 0.0, 0, 100 * len(q) + 200
        while q:
            if len(q) == 1:
                out.append(sigma + q[0])
                break
            if e[-1] <= NEGLIGIBLE * (sigma + q[-1]) or e[-1] <= TINY:
                out.append(sigma + q[-1])
                q, e = q[:-1], e[:-1]
                guess = 0.0
                continue
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= NEGLIGIBLE * (sigma + q[i])), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            sweeps += 1
            if sweeps > most:
                raise ArithmeticError("singular values do not converge")
            if sweeps % 40 == 0:
                q, e = q[::-1], e[::-1]  # the same values, from the other end
            shift, tries = guess, 0
            while True:
                new_q, new_e, seen = _sweep(q, e, shift)
                if shift == 0.0 or min(seen) >= 0 and new_q[-1] >= 0:
                    break
                tries += 1
                late = new_q[-1] < 0 and min(seen[:-1]) > 0
                shift = max(shift + new_q[-1], 0.0) if late and tries == 1 else 0.25 * shift if tries < 4 else 0.0
            q, e, sigma = [max(x, 0.0) for x in new_q], new_e, sigma + shift
            least = min(seen)
            guess = min(_last_pair(q, e), max(q[-1], 0.0)) if least == seen[-1] else 0.25 * max(least, 0.0)
            if guess < EPS * sigma:
                guess = 0.0
    return sorted(out, reverse=True)


class Twisted:
    """Twisted factorisation of L D L' - value, where L D L' = B'B."""

    def __init__(self, pivots: np.ndarray, lower: np.ndarray, value: float):
        n = len(pivots)
        self.scale = max(float(np.abs(pivots).max()), TINY)
        least = EPS * EPS * self.scale
        down, down_l, s = np.empty(n), np.empty(max(n - 1, 0)), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            down[i] = _away(s[i] + pivots[i], least)
            down_l[i] = pivots[i] * lower[i] / down[i]
            s[i + 1] = down_l[i] * lower[i] * s[i] - value
        down[n - 1] = s[n - 1] + pivots[n - 1]
        up, up_l, p = np.empty(n), np.empty(max(n - 1, 0)), np.empty(n)
        p[n - 1] = pivots[n - 1] - value
        for i in range(n - 2, -1, -1):
            up[i + 1] = _away(pivots[i] * lower[i] ** 2 + p[i + 1], least)
            ratio = pivots[i] / up[i + 1]
            up_l[i] = lower[i] * ratio
            p[i] = p[i + 1] * ratio - value
        up[0] = p[0]
        joint = s + p + value
        self.at = int(np.argmin(np.abs(joint)))
        self.down, self.up, self.down_l, self.up_l = down, up, down_l, up_l
        self.joint = joint[self.at]

    def _spread(self, z: np.ndarray) -> np.ndarray:
        """N' z = w solved in place, from the twist outwards."""
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.down_l[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.up_l[i] * z[i]
        return z

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.down))
        z[self.at] = 1.0
        z = self._spread(z)
        return z / np.linalg.norm(z)

    def solve(self, r: np.ndarray) -> np.ndarray:
        """A vector in the direction of (L D L' - value)^-1 r."""
        y, n = r.astype(float).copy(), len(r)
        for i in range(self.at):
            if i:
                y[i] -= self.down_l[i - 1] * y[i - 1]
        for i in range(n - 1, self.at, -1):
            if i < n - 1:
                y[i] -= self.up_l[i] * y[i + 1]
        if self.at:
            y[self.at] -= self.down_l[self.at - 1] * y[self.at - 1]
        if self.at < n - 1:
            y[self.at] -= self.up_l[self.at] * y[self.at + 1]
        small = EPS * self.scale
        y[: self.at] /= _away(self.down[: self.at], small)
        y[self.at + 1 :] /= _away(self.up[self.at + 1 :], small)
        y[self.at] /= _away(self.joint, small)
        z = self._spread(y / np.abs(y).max())
        return z / np.linalg.norm(z)


def _away(x, small: float):
    """x where it is further from 0 than ``small``, else ``small`` with its sign."""
    return np.where(np.abs(x) > small, x, np.where(x < 0, -small, small))


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: list[float]) -> np.ndarray:
    """Right singular vectors, as columns, of an unreduced block for some of its falling values."""
    size = max(float(np.abs(diagonal).max()), float(np.abs(above).max()) if len(above) else 0.0, TINY)
    a = np.where(np.abs(diagonal) < EPS * size * 1e-3, EPS * size * 1e-3, diagonal)
    pivots, lower = a * a, above / a[:-1]
    out = np.empty((len(a), len(values)))
    rng, begin = np.random.default_rng(11), 0
    for j, value in enumerate(values):
        factors = Twisted(pivots, lower, value)
        if j and values[j - 1] - value > CLUSTER * values[j - 1]:
            begin = j
        if begin == j:
            out[:, j] = factors.vector()
            continue
        mates = out[:, begin:j]
        z = factors.vector()
        if np.linalg.norm(mates.T @ z) > 0.5:
            z = rng.standard_normal(len(a))
        for _ in range(4):
            z = z - mates @ (mates.T @ z)
            z = factors.solve(z / np.linalg.norm(z))
            z = z - mates @ (mates.T @ z)
            z = z - mates @ (mates.T @ z)
            z /= np.linalg.norm(z)
        out[:, j] = z
    return out


def right_singular(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest squared singular values, falling, and their right vectors as columns.

    Fewer if the matrix is narrower. Values and vectors of parts of the bidiagonal that do not
    touch are found apart.
    """
    diagonal, above, v = bidiagonalise(a)
    n = len(diagonal)
    size = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if n == 0 or size == 0:
        return np.zeros(min(n, most)), v[:, : min(n, most)]
    beside = np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    above = np.where(np.abs(above) <= EPS * np.maximum(2 * beside, size * 1e-2), 0.0, above)
    cuts = [0, *(i + 1 for i in range(n - 1) if above[i] == 0.0), n]
    found = []
    for begin, end in zip(cuts, cuts[1:]):
        values = singular_values_squared(diagonal[begin:end] / size, above[begin : end - 1] / size)
        found += [(value, begin, end, k) for k, value in enumerate(values)]
    found = sorted(found, key=lambda f: -f[0])[:most]
    vectors = np.zeros((n, len(found)))
    for begin, end in {(f[1], f[2]) for f in found}:
        mine = [j for j, f in enumerate(found) if f[1] == begin]
        part = _block_vectors(diagonal[begin:end] / size, above[begin : end - 1] / size, [found[j][0] for j in mine])
        vectors[begin:end, mine] = part
    return np.array([f[0] for f in found]) * size * size, v @ vectors
