"""Singular values and right singular vectors of a small triangular matrix.

Householder reflections make the matrix upper bidiagonal, differential quotient-
difference steps with shifts (dqds) find its singular values to high relative
accuracy, and twisted factorisations of the tridiagonal ``B'B - s^2`` give the
directions.  Everything here is of the size of one vector's length; the rows
never come this far.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Singular values whose squares lie this close (relatively) share inverse iterations with orthogonalisation.
CLUSTER = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """``v, beta, alpha`` with ``(I - beta v v') x = (alpha, 0, ...)``."""
    v = x.copy()
    scale = np.abs(v).max(initial=0.0)
    if scale == 0 or not np.abs(v[1:]).max(initial=0.0):
        return np.zeros_like(v), 0.0, float(v[0])
    v /= scale
    norm = np.sqrt(v @ v)
    alpha = -norm if v[0] > 0 else norm
    v[0] -= alpha
    return v, float(2.0 / (v @ v)), float(alpha * scale)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, float]]]:
    """Diagonal and superdiagonal of ``U'RV`` and the reflectors that make up ``V``."""
    a = np.array(r, np.float64)
    n = a.shape[1]
    right: list[tuple[np.ndarray, float]] = []
    for k in range(n):
        v, beta, alpha = _reflector(a[k:, k])
        if beta:
            a[k:, k:] -= np.outer(beta * v, v @ a[k:, k:])
        a[k, k], a[k + 1:, k] = alpha, 0.0
        if k < n - 2:
            v, beta, alpha = _reflector(a[k, k + 1:])
            if beta:
                a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ v, beta * v)
            a[k, k + 1], a[k, k + 2:] = alpha, 0.0
            right.append((v, beta))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def turn_back(z: np.ndarray, right: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """``V z`` for columns ``z`` in the bidiagonal's coordinates."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        v, beta = right[k]
        if beta:
            z[k + 1:] -= np.outer(beta * v, v @ z[k + 1:])
    return z


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential step; None if the shift exceeds the smallest value."""
    n = len(q)
    d = q[0] - shift
    least = d
    qq, ee = [0.0] * n, [0.0] * (n - 1)
    for i in range(n - 1):
        if d < 0:
            return None
        top = d + e[i]
        if not top:
            return None
        t = q[i + 1] / top
        qq[i], ee[i] = top, e[i] * t
        d = d * t - shift
        least = min(least, d)
    if d < 0 or d != d:
        return None
    qq[-1] = d
    return qq, ee, least


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal (``a``; ``b`` above it), falling."""
    top = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
    if top == 0:
        return np.zeros(len(a))
    tiny = EPS ** 12
    q0 = [max(float(x) ** 2, tiny) for x in a / top]  # a zero would divide; so small a change is below rounding
    e0 = [float(x) ** 2 for x in b / top]
    found: list[float] = []
    todo = [(q0, e0, 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        shift, rounds = 0.0, 0
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + sigma)
                break
            if e[-1] <= EPS * EPS * (sigma + q[-1]):
                found.append(q[-1] + sigma)
                q, e = q[:-1], e[:-1]
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1] and not rounds % 8:  # graded the wrong way: turned round, the values stay
                q, e = q[::-1], e[::-1]
            if rounds:  # the smaller eigenvalue of the last two rows is close above the smallest one
                t, c, x = q[-2] + e[-1], e[-1] * q[-1], q[-1]
                if n > 2:
                    t += e[-2]
                mean, half = (t + x) / 2, (t - x) / 2
                root = np.sqrt(half * half + c)
                shift = max(0.0, (t * x - c) / (mean + root) if mean + root else 0.0) * (1 - 1e-3)
                shift = min(shift, least)
            out = _step(q, e, shift)
            tries = 0
            while out is None and shift:
                shift = shift / 4 if tries < 3 else 0.0
                tries += 1
                out = _step(q, e, shift)
            if out is None:  # an underflow to zero without a shift
                q = [max(x, tiny) for x in q]
                out = _step(q, e, 0.0)
                if out is None:
                    raise FloatingPointError("dqds met no finite step")
            q, e, least = out
            sigma += shift
            rounds += 1
            if rounds > 100 * len(a) + 1000:
                raise FloatingPointError("dqds did not converge")
    return np.sort(np.array(found))[::-1] * top * top


class Twisted:
    """Twisted factorisation of ``B'B - value`` for the upper bidiagonal (``a``; ``b`` above it)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float) -> None:
        n = len(a)
        floor = EPS * EPS * max(value, float(np.max(a * a, initial=0)), float(np.max(b * b, initial=0)), 1e-280)
        self.down, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        s, p = np.empty(n), np.empty(n)
        self.pivot, self.rise = np.empty(n), np.empty(n)
        s[0] = -value
        for i in range(n - 1):  # stationary, from the top
            d = s[i] + a[i] * a[i]
            d = d if abs(d) > floor else (floor if d >= 0 else -floor)
            self.pivot[i] = d
            self.down[i] = a[i] * b[i] / d
            s[i + 1] = b[i] * b[i] * (s[i] / d) - value
        p[n - 1] = a[n - 1] * a[n - 1] - value
        self.rise[0] = 0.0
        for i in range(n - 2, -1, -1):  # progressive, from the bottom
            d = b[i] * b[i] + p[i + 1]
            d = d if abs(d) > floor else (floor if d >= 0 else -floor)
            self.rise[i + 1] = d
            self.up[i] = a[i] * b[i] / d
            p[i] = p[i + 1] * (a[i] * a[i] / d) - value
        gamma = s + p + value
        self.twist = int(np.argmin(np.abs(gamma)))
        g = gamma[self.twist]
        self.gamma = g if abs(g) > floor else (floor if g >= 0 else -floor)

    def vector(self) -> np.ndarray:
        """The direction that the twist gives, of length one."""
        n, r = len(self.down) + 1, self.twist
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, y: np.ndarray) -> np.ndarray:
        """``x`` with ``(B'B - value) x = y`` (up to its length)."""
        n, r = len(y), self.twist
        x = y.astype(np.float64).copy()
        for i in range(r):
            x[i + 1] -= self.down[i] * x[i]
        for i in range(n - 2, r - 1, -1):
            x[i] -= self.up[i] * x[i + 1]
        x[:r] /= self.pivot[:r]
        x[r + 1:] /= self.rise[r + 1:]
        x[r] /= self.gamma
        for i in range(r - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(r, n - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x / np.linalg.norm(x)


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All squared singular values (falling) of ``r``, the first ``most`` that are not zero, and their right vectors (columns).

    Values below the rounding of the largest count as zero.  Close values get
    orthogonal directions within their common space.
    """
    d = r.shape[1]
    if d == 1:
        square = np.array([float(np.sum(r * r))])
        return square, square[:most][square[:most] > 0], np.ones((1, min(most, int(square[0] > 0))))
    square_rows = r if r.shape[0] >= d else np.vstack([r, np.zeros((d - r.shape[0], d))])
    a, b, right = bidiagonalise(square_rows)
    values = dqds(a, b)
    keep = values[:most][values[:most] > (d * EPS) ** 2 * max(values[0], 0)]
    z = np.zeros((d, len(keep)))
    rng = np.random.default_rng(7)
    first = 0
    for k, value in enumerate(keep):
        if k and keep[k - 1] - value > CLUSTER * keep[k - 1]:
            first = k
        twisted = Twisted(a, b, value)
        v = twisted.vector()
        near = k > first or k + 1 < len(values) and value - values[k + 1] <= CLUSTER * value
        if near:
            others = z[:, first:k]
            if k > first and np.linalg.norm(v - others @ (others.T @ v)) < 0.1:
                v = rng.standard_normal(d)
            for _ in range(4):
                for _ in range(2):
                    v = v - others @ (others.T @ v)
                    v /= np.linalg.norm(v)
                v = twisted.solve(v)
            for _ in range(2):
                v = v - others @ (others.T @ v)
                v /= np.linalg.norm(v)
        z[:, k] = v
    return values, keep, turn_back(z, right)
