"""Exact products of matrices of 64-bit integers by Strassen's recursion."""

from __future__ import annotations

import numpy as np

# Below this in any dimension, numpy multiplies.
LEAF = 32


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for int64 matrices, with seven products of halves in place of eight at every level.

    Rows and columns of zeros are added so that all halves are even; they change nothing and are cut off again. Sums are modulo
    2^64, so whatever the parts grow to, the result is exact wherever the true one fits 64 bits.
    """
    (rows, inner), columns = a.shape, b.shape[1]
    levels = 0
    while min(rows, inner, columns) >> (levels + 1) >= leaf:
        levels += 1
    step = 1 << levels
    return _recursive(_padded(a, step), _padded(b, step), levels)[:rows, :columns]


def _padded(m: np.ndarray, step: int) -> np.ndarray:
    rows, columns = (-size % step for size in m.shape)
    return np.pad(m, ((0, rows), (0, columns))) if rows or columns else m


def _quarters(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    r, c = m.shape[0] // 2, m.shape[1] // 2
    return m[:r, :c], m[:r, c:], m[r:, :c], m[r:, c:]


def _recursive(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    a11, a12, a21, a22 = _quarters(a)
    b11, b12, b21, b22 = _quarters(b)
    times = lambda x, y: _recursive(x, y, levels - 1)
    m1 = times(a11 + a22, b11 + b22)
    m2 = times(a21 + a22, b11)
    m3 = times(a11, b12 - b22)
    m4 = times(a22, b21 - b11)
    m5 = times(a11 + a12, b22)
    m6 = times(a21 - a11, b11 + b12)
    m7 = times(a12 - a22, b21 + b22)
    out = np.empty((a.shape[0], b.shape[1]), np.int64)
    c11, c12, c21, c22 = _quarters(out)
    c11[:] = m1 + m4 - m5 + m7
    c12[:] = m3 + m5
    c21[:] = m2 + m4
    c22[:] = m1 - m2 + m3 + m6
    return out
