"""Singular values and right singular vectors of a small square matrix, by the qd way.

Householder reflections make the matrix upper bidiagonal, the shifted differential qd algorithm
(dqds) finds the squares of its singular values with high relative accuracy, and a twisted
factorisation of each shifted tridiagonal gives the vector that belongs to a value.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_TINY = np.finfo(float).tiny
#: Values closer than this (relative) may need their vectors made orthogonal.
_CLUSTER = 1e-3


def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of ``a = U B V^T`` with B upper bidiagonal; U is not kept."""
    a = np.array(a, dtype=float)
    n = a.shape[1]
    v = np.eye(n)
    for k in range(n):
        w = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(w, w @ a[k:, k:])
        if k < n - 2:
            w = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray:
    """w with (I - w w^T) x along the first axis, |w|^2 = 2; zero where nothing is to be done."""
    size = np.abs(x[1:]).max(initial=0.0)
    if size == 0:
        return np.zeros(len(x))
    w = x / max(size, abs(x[0]))
    w[0] += np.copysign(np.linalg.norm(w), w[0])
    return w * (np.sqrt(2) / np.linalg.norm(w))


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, int, float]:
    """One dqds transform; the place of the first negative pivot (n if none) and that pivot."""
    n = len(q)
    out_q, out_e = np.empty(n), np.empty(max(n - 1, 0))
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return out_q, out_e, i, d
        out_q[i] = max(d + e[i], _TINY)
        ratio = q[i + 1] / out_q[i]
        out_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0:
        return out_q, out_e, n - 1, d
    out_q[n - 1] = d
    return out_q, out_e, n, d


def _last_value(q: np.ndarray, e: np.ndarray) -> float:
    """Smaller eigenvalue of the trailing two rows, a bound from above of the least of all."""
    a, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    half = (a - c) / 2
    root = np.hypot(half, np.sqrt(q[-2]) * np.sqrt(e[-1]))
    big = (a + c) / 2 + root
    det = q[-1] * (q[-2] + (e[-2] if len(e) > 1 else 0.0)) + (e[-1] * e[-2] if len(e) > 1 else 0.0)
    return det / big if big > 0 else 0.0


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values, falling, of an upper bidiagonal with squared entries q, e."""
    found: list[float] = []
    parts = [(np.array(q, float), np.array(e, float), 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        while len(q):
            if len(q) == 1:
                found.append(q[0] + shifted)
                break
            if e[-1] <= _EPS**2 * (q[-1] + shifted) or e[-1] <= _TINY:
                found.append(q[-1] + shifted)
                q, e = q[:-1], e[:-1]
                continue
            cuts = np.flatnonzero(e <= np.maximum(_EPS**2 * (np.minimum(q[:-1], q[1:]) + shifted), _TINY))
            if len(cuts):
                at = int(cuts[-1]) + 1
                parts.append((q[:at], e[: at - 1], shifted))
                q, e = q[at:], e[at:]
                continue
            if q[0] * 1.5 < q[-1]:  # small values at the far end
                q, e = q[::-1].copy(), e[::-1].copy()
            shift = _last_value(q, e)
            for _ in range(6):
                new_q, new_e, bad, pivot = _sweep(q, e, shift)
                if bad == len(q):
                    break
                # A failure at the last pivot alone tells a bound from below.
                shift = shift + pivot if bad == len(q) - 1 else shift / 2
                shift = max(shift * (1 - 4 * _EPS), 0.0)
            else:
                shift = 0.0
                new_q, new_e, _, _ = _sweep(q, e, shift)
            q, e, shifted = new_q, new_e, shifted + shift
    return np.sort(np.maximum(np.array(found), 0.0))[::-1]


def _twisted(diag: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """Unit vector of ``L D L^T - value`` from the twisted factorisation with the least pivot.

    ``diag`` is D, ``low`` the subdiagonal of L.
    """
    n = len(diag)
    down, s = np.empty(max(n - 1, 0)), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + diag[i]
        pivot = pivot if abs(pivot) > _TINY else -_EPS * max(abs(value), _TINY)
        down[i] = diag[i] * low[i] / pivot
        s[i + 1] = down[i] * low[i] * s[i] - value
    up, p = np.empty(max(n - 1, 0)), np.empty(n)
    p[n - 1] = diag[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = diag[i] * low[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > _TINY else -_EPS * max(abs(value), _TINY)
        ratio = diag[i] / pivot
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.empty(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _block_vectors(q: np.ndarray, e: np.ndarray, values: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Vectors (rows) of an unreduced block for its falling ``values``."""
    q = np.maximum(q, _TINY)
    low = signs * np.sqrt(e) / np.sqrt(q[:-1])
    dense = np.diag(q + np.concatenate(([0.0], e)))
    off = low * q[:-1]
    dense[np.arange(len(off)), np.arange(len(off)) + 1] = dense[np.arange(len(off)) + 1, np.arange(len(off))] = off
    rng = np.random.default_rng(0)
    rows: list[np.ndarray] = []
    for i, value in enumerate(values):
        near = [rows[j] for j in range(i) if values[j] - value <= _CLUSTER * values[j]]
        z = _twisted(q, low, value)
        for attempt in range(6):
            rest = z.copy()
            for _ in range(2):
                for other in near:
                    rest -= (other @ rest) * other
            if np.linalg.norm(rest) > 0.5 or attempt == 5:
                break
            # The twisted vector lies in the span of its neighbours' ones: inverse iteration beside them.
            start = rng.standard_normal(len(q))
            for other in near:
                start -= (other @ start) * other
            z = np.linalg.solve(dense - value * (1 + 8 * _EPS * (attempt + 1)) * np.eye(len(q)), start)
            z /= np.linalg.norm(z)
        rows.append(rest / np.linalg.norm(rest))
    return np.array(rows)


def right_vectors(r: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values (all, falling) of ``r``, and the right vectors (rows) of the first
    ``top`` of them; the sign makes each vector's entry of greatest size positive."""
    a, b, v = bidiagonalise(r)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a)), np.eye(len(a))[:top]
    a, b = a / scale, b / scale
    q, e = a * a, b * b
    cuts = [0, *(np.flatnonzero(np.abs(b) <= _EPS * 0.5 * np.minimum(np.abs(a[:-1]), np.abs(a[1:]))) + 1).tolist(), len(q)]
    found = []
    for lo, hi in zip(cuts, cuts[1:]):
        found += [(value, lo, hi, i) for i, value in enumerate(dqds(q[lo:hi], e[lo : hi - 1]))]
    found.sort(key=lambda x: -x[0])
    chosen = found[:top]
    known = {}
    for _, lo, hi, _ in chosen:
        if (lo, hi) not in known:
            values = np.array([x[0] for x in chosen if x[1:3] == (lo, hi)])
            signs = np.sign(a[lo : hi - 1] * b[lo : hi - 1])
            known[lo, hi] = _block_vectors(q[lo:hi], e[lo : hi - 1], values, np.where(signs == 0, 1.0, signs))
    out = np.zeros((len(chosen), len(q)))
    for k, (_, lo, hi, i) in enumerate(chosen):
        out[k] = v[:, lo:hi] @ known[lo, hi][i]
    for row in out:
        row *= np.sign(row[np.argmax(np.abs(row))])
    return np.array([x[0] for x in found]) * scale**2, out
