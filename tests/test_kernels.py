import numpy as np

from lamella.functions import kernels as k


def naive_trilinear(block, z, y, x):
    out = []
    for p in zip(z, y, x, strict=True):
        if not all(-0.5 <= c < n - 0.5 for c, n in zip(p, block.shape, strict=True)):
            out.append(0.0)
            continue
        c = [min(max(v, 0), n - 1) for v, n in zip(p, block.shape, strict=True)]
        total = 0.0
        for corner in np.ndindex(2, 2, 2):
            at, w = [], 1.0
            for v, d, n in zip(c, corner, block.shape, strict=True):
                f = v - int(v)
                w *= f if d else 1 - f
                at.append(min(int(v) + d, n - 1))
            total += w * block[tuple(at)]
        out.append(total)
    return np.array(out)


def test_trilinear_matches_loop():
    rnd = np.random.default_rng(1)
    block = rnd.integers(0, 1000, (5, 6, 7)).astype(float)
    z, y, x = rnd.uniform(-1, 6, (3, 400))
    assert np.allclose(k.trilinear(block, z, y, x), naive_trilinear(block, z, y, x))
