"""Singular values and right singular vectors of a small square matrix, by the qd family.

Householder reflections make the matrix bidiagonal, dqds finds the squared singular values from its squared entries
without a subtraction that loses digits, and twisted factorisations of BᵀB − λ give the vectors. The work depends on
the dimension alone; rows never come here.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Neighbouring values closer than this, relatively, form a cluster whose vectors are made orthogonal to each other.
GAP = 1e-3


def bidiagonalize(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """(diagonal, superdiagonal, right reflectors) of B with r = U B Wᵀ; W is the product of the reflectors."""
    a, n = r.astype(float).copy(), r.shape[1]
    right: list[np.ndarray | None] = []
    for k in range(n):
        if (u := _reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        w = _reflector(a[k, k + 1 :]) if k < n - 2 else None
        if w is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
        right.append(w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit u such that x − 2u(uᵀx) has zeros below its first entry; None where it has them already."""
    if len(x) < 2 or not np.any(x[1:]):
        return None
    u = x / np.abs(x).max()
    u[0] += np.copysign(np.linalg.norm(u), u[0])
    return u / np.linalg.norm(u)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of BᵀB, falling, from q = diagonal², e = superdiagonal².

    The shift of a step is 1 / Σ 1/d of the step before: a lower bound of what is left of the smallest value (Σ 1/d is the
    trace of the inverse), so no step overshoots but by rounding; one that does is repeated with a smaller shift.
    """
    top = float(max(q.max(initial=0.0), e.max(initial=0.0)))
    if top == 0.0:
        return np.zeros(len(q))
    # Exact zeros would divide by zero; this floor is far below what the largest value's last digit can show.
    q = np.maximum(q / top, 1e-60)
    found: list[float] = []
    todo = [(q.tolist(), (e / top).tolist(), 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        shift = 0.0
        while q:
            n = len(q)
            if n == 1 or e[-1] <= EPS * EPS * (sigma + q[-1]):
                found.append(sigma + q.pop())
                e = e[: n - 2]
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * min(q[i], q[i + 1])), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], sigma))
                q, e, shift = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if 1.5 * q[0] < q[-1]:
                # Small values leave at the end: turned round, B keeps its values.
                q, e, shift = q[::-1], e[::-1], 0.0
            while (step := _step(q, e, shift)) is None:
                shift = shift / 4 if shift > EPS * EPS * sigma else 0.0
            sigma += shift
            q, e, inverse = step
            shift = (1 - 4 * EPS) / inverse if inverse < np.inf else 0.0
    return np.sort(np.array(found))[::-1] * top


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform and Σ 1/d, or None where the shift was too large."""
    d, inverse, new_q, new_e = q[0] - shift, 0.0, [], []
    for i, x in enumerate(e):
        if d <= 0 and (d < 0 or shift > 0):
            return None
        inverse += 1 / d if d > 0 else np.inf
        first = d + x
        ratio = q[i + 1] / first
        new_q.append(first)
        new_e.append(x * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, inverse + (1 / d if d > 0 else np.inf)


class Twisted:
    """Twisted factorisation of L D Lᵀ − λ: from both ends to the row where they meet with the smallest pivot."""

    def __init__(self, d: np.ndarray, l: np.ndarray, value: float):
        n, tiny = len(d), EPS * EPS * max(abs(value), float(np.abs(d).max()))
        safe = lambda x: x if abs(x) > tiny else (tiny if x >= 0 else -tiny)
        self.low, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        self.plus, self.minus = np.zeros(n), np.zeros(n)
        s, p = np.zeros(n), np.zeros(n)
        s[0], p[-1] = -value, d[-1] - value
        for i in range(n - 1):
            self.plus[i] = safe(d[i] + s[i])
            self.low[i] = d[i] * l[i] / self.plus[i]
            s[i + 1] = self.low[i] * l[i] * s[i] - value
        for i in range(n - 2, -1, -1):
            self.minus[i + 1] = safe(d[i] * l[i] * l[i] + p[i + 1])
            ratio = d[i] / self.minus[i + 1]
            self.up[i] = l[i] * ratio
            p[i] = p[i + 1] * ratio - value
        pivots = s + p + value
        self.twist = int(np.argmin(np.abs(pivots)))
        self.pivot = safe(pivots[self.twist])

    def vector(self) -> np.ndarray:
        """The solution that is 1 at the twist and zero residual everywhere else, made a unit vector."""
        right = np.zeros(len(self.plus))
        right[self.twist] = 1.0
        return self._back(right)

    def solve(self, b: np.ndarray) -> np.ndarray:
        n, r, y = len(b), self.twist, b.astype(float).copy()
        for i in range(r):
            y[i + 1] -= self.low[i] * y[i]
        for i in range(n - 2, r - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        pivots = np.concatenate([self.plus[:r], [self.pivot], self.minus[r + 1 :]])
        return self._back(y / pivots)

    def _back(self, w: np.ndarray) -> np.ndarray:
        z = w.copy()
        for i in range(self.twist - 1, -1, -1):
            z[i] -= self.low[i] * z[i + 1]
        for i in range(self.twist, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z / np.linalg.norm(z)


def right_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Unit eigenvectors of BᵀB for its ``count`` largest values, as columns."""
    n = len(a)
    a = np.where(np.abs(a) > EPS * EPS * np.abs(a).max(), a, EPS * EPS * np.abs(a).max())
    d, l = a * a, b / a[:-1]
    ends = [0, *[i for i in range(1, n) if values[i - 1] - values[i] > GAP * values[i - 1]], n]
    out = np.zeros((n, count))
    rng = np.random.default_rng(n)
    for first, last in zip(ends, ends[1:]):
        if first >= count:
            break
        if last == first + 1:
            out[:, first] = Twisted(d, l, float(values[first])).vector()
            continue
        group = np.zeros((n, 0))
        for k in range(first, last):
            # Equal values are set a few last digits apart; each vector leaves what the ones before it span.
            factors = Twisted(d, l, float(values[k]) * (1 + 4 * EPS * (k - first)))
            z = rng.standard_normal(n)
            for _ in range(5):
                z = factors.solve(z / np.linalg.norm(z))
                for _ in range(2):
                    z -= group @ (group.T @ z)
                    z /= np.linalg.norm(z)
            group = np.column_stack([group, z])
        image = a[:, None] * group
        image[:-1] += b[:, None] * group[1:]
        rotated, kept = _jacobi(image.T @ image)
        group = group @ kept[:, np.argsort(-rotated, kind="stable")]
        out[:, first : min(last, count)] = group[:, : min(last, count) - first]
    return out


def _jacobi(m: np.ndarray, sweeps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of a small, almost diagonal symmetric matrix by rotations."""
    m, v, n = m.copy(), np.eye(len(m)), len(m)
    for _ in range(sweeps):
        turned = False
        for i in range(n - 1):
            for j in range(i + 1, n):
                if abs(m[i, j]) <= EPS * np.sqrt(abs(m[i, i] * m[j, j])):
                    continue
                turned = True
                tau = (m[j, j] - m[i, i]) / (2 * m[i, j])
                t = (1.0 if tau >= 0 else -1.0) / (abs(tau) + np.hypot(1.0, tau))
                c = 1 / np.hypot(1.0, t)
                turn = np.array([[c, t * c], [-t * c, c]])
                m[:, [i, j]] = m[:, [i, j]] @ turn
                m[[i, j], :] = turn.T @ m[[i, j], :]
                v[:, [i, j]] = v[:, [i, j]] @ turn
        if not turned:
            break
    return np.diag(m).copy(), v


def decompose(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(all squared singular values falling, right singular vectors of the ``count`` largest as columns) of a square matrix.

    A vector's entry of largest magnitude is positive. Vectors of values that are rounding noise beside the largest mean nothing.
    """
    a, b, right = bidiagonalize(r)
    values = dqds(a * a, b * b)
    vectors = right_vectors(a, b, values, count) if values[0] > 0 else np.eye(len(a))[:, :count]
    for k in range(len(right) - 1, -1, -1):
        if (w := right[k]) is not None:
            vectors[k + 1 :] -= 2 * np.outer(w, w @ vectors[k + 1 :])
    peaks = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(peaks < 0, -1.0, 1.0)
