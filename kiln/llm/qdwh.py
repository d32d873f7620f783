"""Eigenvectors of a symmetric matrix by QDWH spectral divide and conquer.

The matrix sign of ``A - shift`` is its orthogonal polar factor U, found by
the dynamically weighted Halley iteration in its QR form (no inverse of an
ill-conditioned matrix). ``(U + 1) / 2`` projects on the invariant subspace
whose eigenvalues lie above the shift. Orthonormal bases of the two subspaces
come from a QR of the projector's largest columns; A is compressed to each of
them and split further, until a block is one component or a multiple of the
identity. Matrices here are as large as the embedding dimension, whatever the
number of rows, so this runs on the driver.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def polar(a: np.ndarray, steps: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix without zero eigenvalues."""
    n = len(a)
    x = a / max(np.linalg.norm(a, 2), np.finfo(float).tiny)
    low = max(1 / (np.linalg.cond(x, 1) * np.sqrt(n)), _EPS)  # lower bound of the singular values
    eye = np.eye(n)
    for _ in range(steps):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        wa = np.sqrt(1 + d) + np.sqrt(max(8 - 4 * d + 8 * (2 - l2) / (l2 * np.sqrt(1 + d)), 0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        low = min(low * (wa + wb * l2) / (1 + wc * l2), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved < 10 * _EPS * np.sqrt(n) and abs(low - 1) < 10 * _EPS:
            break
    return x


def _pivoted(p: np.ndarray, k: int) -> np.ndarray:
    """Orthonormal basis of the range of a projector of rank k: Gram-Schmidt,
    the column with the largest rest first, each made orthogonal twice."""
    rest, basis = p.copy(), []
    for _ in range(k):
        v = rest[:, np.argmax((rest * rest).sum(axis=0))].copy()
        for b in basis * 2:
            v -= b * (b @ v)
        v /= np.linalg.norm(v)
        basis.append(v)
        rest -= np.outer(v, v @ rest)
    return np.stack(basis, axis=1)


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if no
    shift tried separates the eigenvalues cleanly."""
    n, mean = len(a), np.trace(a) / len(a)
    diagonal = np.sort(np.diag(a))
    spread = np.linalg.norm(a - mean * np.eye(n), 2)
    shifts = [np.median(diagonal), mean, *(mean + spread * s for s in (0.31, -0.31, 0.07, -0.07, 0.73, -0.73, 0.93, -0.93))]
    for shift in shifts:
        u = polar(a - shift * np.eye(n))
        p = (u + np.eye(n)) / 2
        k = int(round(np.trace(p)))
        if not 0 < k < n or np.linalg.norm(p @ p - p) > 1e-11 * n:
            continue  # all on one side, or the shift met an eigenvalue
        above = _pivoted(p, k)
        below = _pivoted(np.eye(n) - above @ above.T, n - k)
        if np.linalg.norm(above.T @ a @ below) <= 100 * n * _EPS * np.linalg.norm(a):
            return above, below
    return None


def _two(a: np.ndarray) -> np.ndarray:
    """Rotation that makes a symmetric 2 x 2 matrix diagonal."""
    angle = np.arctan2(2 * a[0, 1], a[0, 0] - a[1, 1]) / 2
    c, s = np.cos(angle), np.sin(angle)
    return np.array([[c, -s], [s, c]])


def _vectors(a: np.ndarray, size: float) -> np.ndarray:
    n = len(a)
    off = a - np.diag(np.diag(a))
    if n == 1 or np.linalg.norm(off) <= 4 * _EPS * size:
        return np.eye(n)
    if n == 2:
        return _two(a)
    halves = _split(a)
    if halves is None:  # eigenvalues too close for any shift: rotate the largest entry away first
        i, j = np.unravel_index(np.argmax(np.abs(off)), off.shape)
        g = np.eye(n)
        g[np.ix_([i, j], [i, j])] = _two(a[np.ix_([i, j], [i, j])])
        return g @ _vectors(g.T @ a @ g, size)
    out = []
    for basis in halves:
        part = basis.T @ a @ basis
        out.append(basis @ _vectors((part + part.T) / 2, size))
    return np.concatenate(out, axis=1)


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns). The sign of each
    vector is fixed: its entry of largest size is positive."""
    a = (a + a.T) / 2
    v = _vectors(a, np.linalg.norm(a))
    v = np.linalg.qr(v)[0] if len(a) else v  # orthonormal to the last bit, order kept
    b = v.T @ a @ v
    # one step of first-order correction between well-separated components
    e = np.diag(b)
    gap = e[None, :] - e[:, None]
    far = np.abs(gap) > 1e-6 * max(np.abs(e).max(initial=0), np.finfo(float).tiny)
    np.fill_diagonal(far, False)
    turn = np.where(far, b, 0) / np.where(far, gap, 1)
    v = np.linalg.qr(v @ (np.eye(len(a)) + turn))[0] if len(a) else v
    e = np.einsum("ij,ik,kj->j", v, a, v)
    order = np.argsort(-e, kind="stable")
    v, e = v[:, order], e[order]
    sign = np.sign(v[np.argmax(np.abs(v), axis=0), np.arange(len(e))])
    return e, v * np.where(sign == 0, 1, sign)
