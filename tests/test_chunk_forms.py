import numpy as np

from lamella.functions.kernels import trilinear
from lamella.operators import chunks, surface, volume
from lamella.sources import store

SCHEMA = "slice_id int, z int, y int, x int, v int"


def voxels(spark, block):
    z, y, x = (a.tolist() for a in np.nonzero(block))
    return spark.createDataFrame([(1, *p, int(block[p])) for p in zip(z, y, x, strict=True)], SCHEMA)


def dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.z, r.y, r.x] = r.v
    return out


def sparse_block(seed, shape, share):
    rng = np.random.default_rng(seed)
    return np.where(rng.random(shape) < share, rng.integers(1, 4000, shape), 0)


def test_downsample_takes_the_last_value_past_the_last_voxel(spark):
    block = sparse_block(1, (10, 9, 11), 0.6)
    source, factor = {"z": 10, "y": 9, "x": 11}, {"z": 1.35, "y": 2.1, "x": 3.0}
    sizes = [int(-(-source[a] // factor[a])) for a in "zyx"]
    at = [g * factor[a] for g, a in zip(np.meshgrid(*[np.arange(n) for n in sizes], indexing="ij"), "zyx", strict=True)]
    want = trilinear(block.astype(float), *at)
    assert (sizes[0] - 1) * factor["z"] > 9
    given = voxels(spark, block)
    np.testing.assert_allclose(dense(volume.downsample(given, ["slice_id"], source, factor), sizes), want, atol=1e-9)
    small = store.to_voxels(chunks.downsample_chunks(store.from_voxels(given, ["slice_id"], 4), ["slice_id"], source, factor, 4))
    np.testing.assert_array_equal(dense(small, sizes), np.floor(np.round(want, 6) + 0.5))


def test_fill_blank_passes_over_absent_chunks(spark):
    block = sparse_block(2, (14, 6, 5), 0.15)
    block[4:12, :4] = 0  # two chunks along z without a voxel
    block[:, 4:, :] = np.where(block[:, 4:, :] > 90, 0, block[:, 4:, :])  # nothing above 90
    block[13, 0, 0], block[0, 1, 1] = 91, 90
    want = np.zeros_like(block)
    for y, x in np.ndindex(6, 5):
        seen = [v if v > surface.BLANK else 0 for v in block[:, y, x]]
        for z in range(14):
            before = [v for v in seen[: z + 1] if v]
            after = [v for v in seen[z:] if v]
            want[z, y, x] = before[-1] if before else after[0] if after else 0
    got = chunks.fill_blank_chunks(store.from_voxels(voxels(spark, block), ["slice_id"], 4), ["slice_id"], 14, 4)
    np.testing.assert_array_equal(dense(store.to_voxels(got), block.shape), want)


def test_no_chunks_and_empty_regions_give_no_rows(spark):
    none = store.from_voxels(spark.createDataFrame([], SCHEMA), ["slice_id"], 4)
    size = dict.fromkeys("zyx", 8)
    assert chunks.fill_blank_chunks(none, ["slice_id"], 8, 4).isEmpty()
    assert chunks.downsample_chunks(none, ["slice_id"], size, dict.fromkeys("zyx", 2), 4).isEmpty()
    some = store.from_voxels(spark.createDataFrame([(1, 1, 1, 1, 7)], SCHEMA), ["slice_id"], 4)
    field = spark.createDataFrame([], "slice_id int, plane int, gy int, gx int, dx double, dy double, dz double")
    warp = lambda roi: chunks.warp_chunks(some, ["slice_id"], field, size, size, 4, dict.fromkeys("zyx", 1.0), 1.0, 4.0, 2, 2, 8.0, roi)
    assert warp({"z": (0, 0.5), "y": (0, 8), "x": (0, 8)}).isEmpty()
    moved = store.to_voxels(warp({"z": (1, 8), "y": (0, 8), "x": (-2, 8)})).collect()
    assert [(r.z, r.y, r.x, r.v) for r in moved] == [(0, 1, 3, 7)]
