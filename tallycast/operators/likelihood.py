"""Exact Gaussian likelihood of an ARMA series, in time linear in its length.

The values past the first max(p, q) are put through the autoregressive part, so
that their covariance has a narrow band (Brockwell and Davis 1991, ch. 5 and 8);
a band Cholesky factor, taken block by block, whitens the series and gives the determinant. With the
variance concentrated out, the likelihood is largest where the whitened values,
scaled by the determinant, have the least sum of squares: the same damped
Gauss-Newton search as for conditional least squares finds it.
"""

from __future__ import annotations

import numpy as np


def autocovariance(ar: np.ndarray, ma: np.ndarray, n: int) -> np.ndarray:
    """Lags 0 .. n - 1 for shocks of variance one; polynomials with leading 1."""
    p, q = len(ar) - 1, len(ma) - 1
    psi = np.zeros(q + 1)
    for j in range(q + 1):
        i = np.arange(1, min(p, j) + 1)
        psi[j] = ma[j] - ar[i] @ psi[j - i]
    right = np.array([ma[k:] @ psi[:q + 1 - k] if k <= q else 0.0 for k in range(max(p + 1, n))])
    left = np.zeros((p + 1, p + 1))
    rows, cols = np.indices(left.shape)
    np.add.at(left, (rows, np.abs(rows - cols)), ar[cols])
    gamma = np.zeros(max(p + 1, n))
    gamma[:p + 1] = np.linalg.solve(left, right[:p + 1])
    for k in range(p + 1, n):
        gamma[k] = right[k] - ar[1:] @ gamma[k - np.arange(1, p + 1)]
    return gamma[:n]


def whiten(x: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, float]:
    """Independent values of equal variance, and the log determinant."""
    p, q, n = len(ar) - 1, len(ma) - 1, len(x)
    m = min(max(p, q), n)
    filtered = np.convolve(ar, x)[:n]
    value = np.concatenate([x[:m], filtered[m:]])
    width = max(m - 1, q, 0)
    # band[j, k] is the covariance of values j and j + k.
    # Blocks at least as wide as the band have neighbours only; ones fill up the last.
    size = max(width, 16)
    count = -(-n // size)
    band = np.zeros((count * size, width + 1))
    far = np.array([ma[k:] @ ma[:q + 1 - k] if k <= q else 0.0 for k in range(width + 1)])
    band[m:n] = far
    if m:
        gamma = autocovariance(ar, ma, m + width + 1)
        # Covariance of an unfiltered value with the filtered one k days later.
        mixed = np.array([ar @ gamma[np.abs(k - np.arange(p + 1))] for k in range(width + 1)])
        for j in range(m):
            inside = np.arange(width + 1) + j < m
            band[j] = np.where(inside, gamma[:width + 1], mixed)
    band[n:, 0] = 1
    ahead = np.arange(width + 1)
    band[(np.arange(len(band))[:, None] + ahead >= n) & (ahead > 0)] = 0
    i, j = np.indices((size, size))
    gap, below = np.abs(i - j), size + i - j
    at = np.arange(count)[:, None, None] * size
    inner = np.where(gap <= width, band[at + np.minimum(i, j), np.minimum(gap, width)], 0.0)
    lower = np.where(below <= width, band[at + j, np.minimum(below, width)], 0.0)
    left = np.concatenate([value, np.zeros(len(band) - n)]).reshape(count, size)
    z, logdet, side = np.zeros((count, size)), 0.0, np.zeros((size, size))
    for b in range(count):
        try:
            factor = np.linalg.cholesky(inner[b] - side @ side.T)
        except np.linalg.LinAlgError:
            return np.full(n, np.nan), np.nan
        if b:
            left[b] -= side @ z[b - 1]
        solved = np.linalg.solve(factor, np.column_stack([lower[b].T, left[b]]))
        side, z[b] = solved[:, :-1].T, solved[:, -1]
        logdet += 2 * np.log(np.diag(factor)).sum()
    return z.ravel()[:n], logdet
