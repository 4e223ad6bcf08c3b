"""Numpy kernels that run inside one group or chunk; no Spark here.

A sample position in [-0.5, n - 0.5) is inside and clamps, others give 0 or leave a point.
"""

from __future__ import annotations

import numpy as np


def bilinear(image: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values at positions, clamped to the image."""
    h, w = image.shape
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = y - y0, x - x0
    return (image[y0, x0] * (1 - fx) + image[y0, x1] * fx) * (1 - fy) + (image[y1, x0] * (1 - fx) + image[y1, x1] * fx) * fy


def trilinear(block: np.ndarray, z: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values at positions, 0 outside."""
    inside = np.ones(z.shape, bool)
    for p, n in zip((z, y, x), block.shape, strict=True):
        inside &= (p >= -0.5) & (p < n - 0.5)
    out = np.zeros(z.shape)
    at = [np.clip(p[inside], 0, n - 1) for p, n in zip((z, y, x), block.shape, strict=True)]
    low = [np.floor(p).astype(int) for p in at]
    high = [np.minimum(k + 1, n - 1) for k, n in zip(low, block.shape, strict=True)]
    part = np.zeros(at[0].shape)
    for corner in np.ndindex(2, 2, 2):
        w = np.prod([p - k if c else 1 - (p - k) for c, p, k in zip(corner, at, low, strict=True)], axis=0)
        part += w * block[tuple(h if c else k for c, k, h in zip(corner, low, high, strict=True))]
    out[inside] = part
    return out
