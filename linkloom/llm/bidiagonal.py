"""Singular values and right singular vectors of a small triangular matrix by the qd algorithm.

Householder reflections make the matrix bidiagonal; dqds, the differential qd transform with
shifts, finds the squares of its singular values one by one from the bottom; the vectors come from
twisted factorisations of the tridiagonal product, taken where the twist element is smallest.
Vectors of values that are equal or nearly so are made orthogonal to the ones before, from
another twist where the first gives nothing new, and pairs that rounding has left oblique are rotated.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
# Squared off-diagonal entries are dropped below this share of the value beside them.
_NEGLIGIBLE = (8 * EPS) ** 2
_TINY = 1e-290
# Columns that meet at a smaller cosine than this count as orthogonal.
_OBLIQUE = 64 * EPS
_SWEEPS = 12


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``v`` and the first entry of ``(I - 2 v v') x``, whose other entries are zero."""
    v = x.copy()
    size = float(np.linalg.norm(x))
    first = -size if x[0] >= 0 else size
    v[0] -= first
    length = float(np.linalg.norm(v))
    return (v / length if length > 0 else v), first


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and ``v`` with ``r v = u b`` for the bidiagonal ``b`` and some orthogonal ``u``."""
    a = np.array(r, dtype=np.float64)
    n = a.shape[1]
    v = np.eye(n)
    diagonal, upper = np.zeros(n), np.zeros(max(0, n - 1))
    for j in range(n):
        w, diagonal[j] = _reflector(a[j:, j])
        a[j:, j:] -= np.outer(2 * w, w @ a[j:, j:])
        if j < n - 1:
            w, upper[j] = _reflector(a[j, j + 1 :])
            a[j:, j + 1 :] -= np.outer(a[j:, j + 1 :] @ w, 2 * w)
            v[:, j + 1 :] -= np.outer(v[:, j + 1 :] @ w, 2 * w)
    return diagonal, upper, v


def _transformed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform and its smallest ``d``; None if the shift is above the smallest eigenvalue."""
    new_q, new_e = [], []
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return None
        top = max(d + e[i], _TINY)
        ratio = q[i + 1] / top
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, in falling order."""
    scale = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(upper).max(initial=0)))
    if scale == 0:
        return np.zeros(len(diagonal))
    # A zero on the diagonal is raised to what rounding makes of the largest entry.
    q = [float(x) for x in np.maximum((diagonal / scale) ** 2, EPS**4)]
    e = [float(x) for x in (upper / scale) ** 2]
    found, moved, least, rounds = [], 0.0, None, 0
    while q:
        if len(q) == 1 or e[-1] <= _NEGLIGIBLE * (moved + q[-1]) or rounds > 200:
            found.append(moved + q.pop())
            if e:
                e.pop()
            least, rounds = None, 0
            continue
        if q[-1] > 1.5 * q[0]:  # the small end goes to the bottom, where values are taken off
            q, e = q[::-1], e[::-1]
            least = None
        # Every shift below the smallest eigenvalue keeps all entries positive; one that fails is made smaller.
        for shift in (0.0,) if least is None else (least * 0.96, least * 0.6, least * 0.1, 0.0):
            step = _transformed(q, e, shift)
            if step is not None:
                break
        q, e, least = step
        moved += shift
        rounds += 1
    return np.sort(np.array(found))[::-1] * scale**2


def _twists(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stationary and progressive multipliers and the twist elements, a column for each of ``values``."""
    n = len(diagonal)
    floor = max(float((diagonal**2).max()), _TINY) * EPS**4
    pivot = np.maximum(diagonal**2, floor)
    low = upper * diagonal[:-1] / pivot[:-1]

    def firm(x: np.ndarray) -> np.ndarray:
        return np.where(np.abs(x) < floor, np.where(x < 0, -floor, floor), x)

    down, up = np.zeros((n, len(values))), np.zeros((n, len(values)))
    s, p = np.zeros((n, len(values))), np.zeros((n, len(values)))
    s[0] = -values
    for i in range(n - 1):
        down[i] = pivot[i] * low[i] / firm(pivot[i] + s[i])
        s[i + 1] = down[i] * low[i] * s[i] - values
    p[n - 1] = pivot[n - 1] - values
    for i in range(n - 2, -1, -1):
        ratio = pivot[i] / firm(pivot[i] * low[i] ** 2 + p[i + 1])
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - values
    return down, up, s + p + values


def _vector(down: np.ndarray, up: np.ndarray, twist: int) -> np.ndarray:
    z = np.zeros(len(down))
    z[twist] = 1
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, len(down) - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def tridiagonal_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal columns, one for each of ``values``, near the eigenvectors of ``b' b``."""
    n = len(diagonal)
    out = np.zeros((n, n))
    down, up, twist = _twists(diagonal, upper, values)
    twist = np.where(np.isfinite(twist), np.abs(twist), np.inf)
    for j in range(n):
        best, left = None, 0.0
        for k in np.argsort(twist[:, j], kind="stable"):
            with np.errstate(over="ignore", invalid="ignore"):
                z = _vector(down[:, j], up[:, j], int(k))
            if not np.isfinite(z).all():
                continue
            for _ in range(2):
                z = z - out[:, :j] @ (out[:, :j].T @ z)
            size = float(np.linalg.norm(z))
            if size > left:
                best, left = z / size, size
            if left > 0.5:
                break
        if best is None or left < 1e-6:  # nothing new from any twist: a unit vector as far from the others as there is
            free = np.eye(n) - out[:, :j] @ out[:, :j].T
            best = free[:, int(np.argmax(np.diag(free)))]
            best = best - out[:, :j] @ (out[:, :j].T @ best)
            best = best / np.linalg.norm(best)
        out[:, j] = best
    return out


def _rotated(r: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``r v`` and ``v`` with pairs of columns rotated until all columns of ``r v`` are orthogonal."""
    g = r @ v
    for _ in range(_SWEEPS):
        sizes = np.linalg.norm(g, axis=0)
        firm = sizes > len(sizes) * EPS * max(float(sizes.max(initial=0)), _TINY)
        unit = np.where(firm, g / np.where(sizes > 0, sizes, 1), 0)
        pairs = np.argwhere(np.triu(np.abs(unit.T @ unit), 1) > _OBLIQUE)
        if len(pairs) == 0:
            break
        for i, j in pairs:
            aa, bb, ab = g[:, i] @ g[:, i], g[:, j] @ g[:, j], g[:, i] @ g[:, j]
            if ab == 0:
                continue
            half = (bb - aa) / (2 * ab)
            t = (1 if half >= 0 else -1) / (abs(half) + np.hypot(1, half))
            c = 1 / np.hypot(1, t)
            turn = np.array([[c, c * t], [-c * t, c]])
            g[:, [i, j]] = g[:, [i, j]] @ turn
            v[:, [i, j]] = v[:, [i, j]] @ turn
    return g, v


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the square matrix ``r`` in falling order, and the right singular vectors as columns."""
    r = np.asarray(r, dtype=np.float64)
    if r.size == 0 or not r.any():
        return np.zeros(r.shape[1]), np.eye(r.shape[1])
    diagonal, upper, v = bidiagonalise(r)
    vectors = tridiagonal_vectors(diagonal, upper, squared_singular_values(diagonal, upper))
    g, v = _rotated(r, v @ vectors)
    sizes = np.linalg.norm(g, axis=0)
    order = np.argsort(-sizes, kind="stable")
    return sizes[order], v[:, order]
