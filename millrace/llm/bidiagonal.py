"""Singular values and right singular vectors of a small square matrix by way of its bidiagonal form.

Householder reflections make the matrix bidiagonal, differential qd transforms with shifts find the squared singular values to high
relative accuracy, and twisted factorisations of the shifted tridiagonal give their vectors, for all values side by side.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo("f8").eps)
CLOSE = 1e-7  # relative distance under which values share their vectors' space
SWEEPS = 60  # qd transforms for each value at most


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right factor: matrix = U B V' with V the right factor."""
    a = np.array(matrix, "f8")
    n = len(a)
    right = np.eye(n)
    for k in range(n):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v = _reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector whose reflection leaves only the first entry; None if nothing is to be done."""
    size = np.abs(x).max(initial=0)
    if not np.abs(x[1:]).max(initial=0):
        return None
    v = x / size
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v / np.sqrt(v @ v)


def qd_values(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of the qd array: squares of the singular values of the bidiagonal with diagonal sqrt(q) and upper diagonal sqrt(e)."""
    found: list[float] = []
    parts = [(list(map(float, q)), list(map(float, e)), 0.0)]
    while parts:
        q, e, shift = parts.pop()
        least, left = None, SWEEPS * len(q) + SWEEPS
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + shift)
                break
            if e[-1] <= EPS * EPS * (shift + q[-1]) or e[-1] <= EPS * EPS * q[-2] * q[-1] / (q[-1] + q[-2] or 1):
                found.append(q.pop() + shift)
                e.pop()
                least = None
                continue
            if n == 2:
                found += [x + shift for x in _two(q[0], e[0], q[1])]
                break
            cut = next((i for i in range(n - 2) if e[i] <= EPS * EPS * min(q[i], q[i + 1])), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], shift))
                q, e, least = q[cut + 1 :], e[cut + 1 :], None
                continue
            left -= 1
            if left < 0:
                raise ArithmeticError("qd transforms do not converge")
            # The least pivot of the last transform is above the least value by little once it has settled; if it is not, a bound is taken that is never above.
            done = _transform(q, e, least * (1 - 1e-8)) if least else None
            tried = least * (1 - 1e-8) if done else 0.0
            if done is None:
                flat = _transform(q, e, 0.0)
                tried = 0.5 * _below(flat[2])
                done = (tried and _transform(q, e, tried)) or flat
                tried = tried if done is not flat else 0.0
            q, e, pivots = done
            shift += tried
            least = min(pivots)
    return np.sort(np.array(found))[::-1]


def _below(pivots: list[float]) -> float:
    """One over the trace of the inverse: at most the least value."""
    return 1 / sum(1 / p for p in pivots) if min(pivots) > 0 else 0.0


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential qd transform with a shift, and its pivots; None if the shift is above the least value."""
    new_q, new_e, pivots = [], [], []
    d = q[0] - shift
    for i, up in enumerate(e):
        if d < 0:
            return None
        pivots.append(d)
        total = d + up
        new_q.append(total)
        ratio = q[i + 1] / total if total else 0.0
        new_e.append(up * ratio)
        d = d * ratio - shift if total else q[i + 1] - shift
    if d < 0:
        return None
    pivots.append(d)
    new_q.append(d)
    return new_q, new_e, pivots


def _two(q1: float, e1: float, q2: float) -> tuple[float, float]:
    """Both eigenvalues of a qd array of two."""
    total, product = q1 + e1 + q2, q1 * q2
    high = 0.5 * (total + np.sqrt(max(0.0, (q1 - q2) ** 2 + e1 * (2 * (q1 + q2) + e1))))
    return float(high), float(product / high) if high else 0.0


def twisted_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors, as columns, of B'B for its eigenvalues; B is bidiagonal with diagonal a, none of it zero, and upper diagonal b."""
    n, k = len(a), len(values)
    tiny = EPS * EPS * max(float((a * a).max()), 1e-300)
    pivot, low = a * a, b / a[:-1]
    down, up = np.zeros((n, k)), np.zeros((n, k))  # multipliers to the row above and to the row below
    s, p = np.zeros((n, k)), np.zeros((n, k))
    s[0] = -values
    for i in range(n - 1):
        d = _not_zero(s[i] + pivot[i], tiny)
        down[i] = pivot[i] * low[i] / d
        s[i + 1] = down[i] * low[i] * s[i] - values
    p[n - 1] = pivot[n - 1] - values
    for i in range(n - 2, -1, -1):
        ratio = pivot[i] / _not_zero(pivot[i] * low[i] * low[i] + p[i + 1], tiny)
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - values
    twist = np.argmin(np.abs(s + p + values), axis=0)
    z = np.zeros((n, k))
    z[twist, np.arange(k)] = 1
    for i in range(n - 2, -1, -1):
        z[i] = np.where(i < twist, -down[i] * z[i + 1], z[i])
    for i in range(n - 1):
        z[i + 1] = np.where(i >= twist, -up[i] * z[i], z[i + 1])
    size = np.abs(z).max(0)
    z /= size
    return z / np.sqrt((z * z).sum(0))


def _not_zero(x: np.ndarray, tiny: float) -> np.ndarray:
    return np.where(np.abs(x) < tiny, np.copysign(tiny, x), x)


def _block(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors of an unreduced bidiagonal block."""
    floor = EPS * max(float(np.abs(a).max()), float(np.abs(b).max(initial=0)))
    a = np.where(np.abs(a) < floor, np.copysign(max(floor, 1e-300), a), a)
    values = qd_values(a * a, b * b)
    vectors = twisted_vectors(a, b, values)
    gap = np.abs(np.diff(values)) <= CLOSE * values[:-1]
    close = np.zeros(len(values), bool)
    close[1:] |= gap
    close[:-1] |= gap
    # Also values that are nothing beside the largest: their vectors are known only together.
    close |= values <= (8 * len(a) * EPS) ** 2 * values[0]
    if close.any():
        rest = np.linalg.qr(vectors[:, ~close], mode="complete")[0][:, (~close).sum() :]
        image = a[:, None] * rest
        image[:-1] += b[:, None] * rest[1:]
        middle = float(values[close].mean())
        _, turn = np.linalg.eigh(image.T @ image - middle * np.eye(len(image.T)))
        vectors[:, close] = rest @ turn[:, ::-1]
    return values, vectors


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the singular values of a square matrix, falling, and the right singular vectors as columns."""
    a, b, right = bidiagonalise(matrix)
    n = len(a)
    norm = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * EPS * norm) + 1).tolist(), n] if norm else list(range(n + 1))
    values, vectors = np.zeros(n), np.zeros((n, n))
    for x, y in zip(cuts, cuts[1:]):
        if y - x == 1:
            values[x], vectors[x, x] = a[x] * a[x], 1
        else:
            values[x:y], vectors[x:y, x:y] = _block(a[x:y], b[x : y - 1])
    order = np.argsort(-values, kind="stable")
    return values[order], (right @ vectors)[:, order]
