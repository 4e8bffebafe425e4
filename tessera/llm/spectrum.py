"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of ``a - s I``, read from the signs of its LDL' factors, counts the
eigenvalues above ``s``.  Bisection over such counts isolates one leading
eigenvalue after the other; Rayleigh quotient iteration, started inside the
isolated interval, converges cubically to its eigenpair.  An iterate that
leaves its interval is thrown away and the interval is halved.  Eigenvalues
that no count can separate in double precision form a cluster, whose basis is
found by inverse iteration.  At the end counts certify the numbering.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(np.float64).eps
#: Bunch and Kaufman's bound for a pivot of one row.
ALPHA = (1 + math.sqrt(17)) / 8


class Factors:
    """P (a - shift I) P' = L D L' with pivots of one or two rows."""

    def __init__(self, a: np.ndarray, shift: float):
        n = len(a)
        a = a - shift * np.eye(n)
        self.order, self.lower, self.pivots = np.arange(n), np.eye(n), []
        tiny = EPS * max(np.abs(a).max(), np.finfo(np.float64).tiny)
        k = 0
        while k < n:
            wide = self._choose(a, k)
            at, rest = slice(k, k + wide), slice(k + wide, n)
            if wide == 1 and abs(a[k, k]) < tiny:  # the shift is an eigenvalue: the smallest pivot that still divides
                a[k, k] = math.copysign(tiny, a[k, k])
            pivot = a[at, at].copy()
            part = np.linalg.solve(pivot, a[at, rest]).T if wide == 2 else a[rest, at] / pivot[0, 0]
            self.lower[rest, at] = part
            a[rest, rest] -= part @ a[at, rest]
            self.pivots.append((k, pivot))
            k += wide

    def _swap(self, a: np.ndarray, i: int, j: int, done: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]
        self.order[[i, j]] = self.order[[j, i]]
        self.lower[[i, j], :done] = self.lower[[j, i], :done]

    def _choose(self, a: np.ndarray, k: int) -> int:
        """Move the next pivot to row k; how many rows it takes."""
        if k + 1 == len(a):
            return 1
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax())
        most = below[r - k - 1]
        if abs(a[k, k]) >= ALPHA * most:
            return 1
        row = np.abs(a[r, k:])
        row[r - k] = 0
        widest = row.max()
        if abs(a[k, k]) * widest >= ALPHA * most * most:
            return 1
        if abs(a[r, r]) >= ALPHA * widest:
            self._swap(a, k, r, k)
            return 1
        self._swap(a, k + 1, r, k)
        return 2

    def positive(self) -> int:
        """How many eigenvalues lie above the shift."""
        count = 0
        for _, p in self.pivots:
            if len(p) == 1:
                count += p[0, 0] > 0
            else:  # a pivot of two rows has a negative determinant but for rounding
                count += 1 if np.linalg.det(p) < 0 else 2 * (p[0, 0] > 0)
        return int(count)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].copy()
        for k in range(len(x)):
            x[k + 1:] -= self.lower[k + 1:, k] * x[k]
        for k, p in self.pivots:
            x[k: k + len(p)] = np.linalg.solve(p, x[k: k + len(p)])
        for k in range(len(x) - 1, -1, -1):
            x[k] -= self.lower[k + 1:, k] @ x[k + 1:]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Slicer:
    def __init__(self, a: np.ndarray):
        self.a = np.asarray(a, np.float64)
        self.size = float(np.abs(self.a).sum(axis=1).max()) if len(a) else 0.0  # no eigenvalue is larger
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = Factors(self.a, shift).positive()
        return self.counts[shift]

    def isolate(self, k: int, low: float, high: float) -> tuple[float, float]:
        """Halve (low, high] until it holds the k-th largest eigenvalue alone, or rounding stops it."""
        while (self.above(low) > k or self.above(high) < k - 1) and high - low > 4 * EPS * self.size:
            low, high = self._halve(k, low, high)
        return low, high

    def _halve(self, k: int, low: float, high: float) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) >= k else (low, middle)

    def _bracket(self, k: int) -> tuple[float, float]:
        """The narrowest interval that the counts so far prove to hold eigenvalue k."""
        low = max((s for s, c in self.counts.items() if c >= k), default=-2 * self.size)
        high = min((s for s, c in self.counts.items() if c < k and s > low), default=2 * self.size)
        return low, high

    def pair(self, k: int, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
        low, high = self.isolate(k, *self._bracket(k))
        start = np.random.default_rng(k).standard_normal(len(self.a))
        while True:
            value, x, error = self._iterate(low, high, start, found)
            width = high - low
            slack = 4 * EPS * self.size
            if low - slack <= value <= high + slack and error <= 64 * EPS * self.size:
                return value, x
            if width <= slack:  # a cluster: any basis of it will do
                return value, x
            low, high = self._halve(k, low, high)

    def _iterate(self, low: float, high: float, x: np.ndarray, found: list[np.ndarray]):
        """Inverse iteration at the middle of the interval, then Rayleigh quotient iteration."""
        middle = Factors(self.a, (low + high) / 2)
        x = self._apart(x, found)
        for _ in range(3):
            x = self._apart(middle.solve(x), found)
        value, best = float(x @ self.a @ x), (math.inf, 0.0, x)
        for _ in range(12):
            error = float(np.linalg.norm(self.a @ x - value * x))
            if error < best[0]:
                best = (error, value, x)
            elif best[0] <= 64 * EPS * self.size:
                break
            if error <= EPS * self.size or not low <= value <= high:
                break
            x = self._apart(Factors(self.a, value).solve(x), found)
            value = float(x @ self.a @ x)
        error, value, x = best
        return value, x, error

    @staticmethod
    def _apart(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        """Unit vector orthogonal to the eigenvectors found before."""
        for _ in range(2):
            x = x / np.linalg.norm(x)
            for v in found:
                x = x - (v @ x) * v
        return x / np.linalg.norm(x)

    def certify(self, k: int, value: float) -> None:
        slack = 64 * max(len(self.a), 1) * EPS * self.size
        if self.above(value - slack) < k or self.above(value + slack) >= k:
            raise ArithmeticError(f"eigenvalue {k} is not number {k} by the inertia counts")


def leading_eigenpairs(a: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of ``a``, falling, and their unit eigenvectors as columns; only values above ``floor``."""
    s = Slicer(a)
    n = min(k, len(s.a), s.above(floor)) if s.size > 0 else 0
    values, vectors = [], []
    for i in range(1, n + 1):
        value, x = s.pair(i, vectors)
        values.append(value)
        vectors.append(x)
    for i, value in enumerate(values, 1):
        s.certify(i, value)
    order = sorted(range(n), key=lambda i: -values[i])  # members of a cluster may differ in the last bits
    return np.array([values[i] for i in order]), np.array([vectors[i] for i in order]).reshape(n, len(s.a)).T
