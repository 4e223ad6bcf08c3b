import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.functions.pixels import log_intensity
from lamella.operators import register, scores
from lamella.sources import store

KEYS = ["slice_id"]
SHAPE = "slice_id int, z int, y int, x int, v int"


def frame(spark, block, key=1, at=(0, 0, 0)):
    rows = [(key, int(z) + at[0], int(y) + at[1], int(x) + at[2], int(v)) for (z, y, x), v in np.ndenumerate(block) if v]
    return spark.createDataFrame(rows, SHAPE)


def smooth_block(seed, n):
    """Blobs that stay alike when halved."""
    rnd = np.random.default_rng(seed)
    z, y, x = np.mgrid[:n, :n, :n]
    out = np.zeros((n, n, n))
    for _ in range(12):
        c = rnd.uniform(0, n, 3)
        out += rnd.uniform(200, 900) * np.exp(-((z - c[0]) ** 2 + (y - c[1]) ** 2 + (x - c[2]) ** 2) / 12)
    return (out + 1).astype(int)


@pytest.mark.parametrize("size", [3, 4, 8])
def test_chunk_scores_equal_long_form(spark, size):
    rnd = np.random.default_rng(size)
    a, b = (rnd.integers(0, 900, (7, 9, 8)) * (rnd.random((7, 9, 8)) < 0.7) for _ in "ab")
    fixed, moving = frame(spark, a), frame(spark, b, at=(1, 0, 2))
    packed = [store.from_voxels(f, KEYS, size) for f in (fixed, moving)]
    ranges = [(-2, 1), (0, 2), (-1, 3)]
    want = register.translation_ncc(fixed, moving, KEYS, ranges, int((a > 0).sum())).collect()
    assert scores.translation_ncc_chunks(*packed, KEYS, ranges).collect() == want
    mutual = register.align_channel(fixed, moving, KEYS, ranges, 128).first()
    got = scores.align_channel_chunks(*packed, KEYS, ranges, 128).first()
    assert (got.sx, got.sy, got.sz) == (mutual.sx, mutual.sy, mutual.sz) and abs(got.mi - mutual.mi) < 1e-8


def test_search_over_levels_finds_a_shift_past_one_level(spark):
    block = smooth_block(3, 24)
    fixed = frame(spark, block).union(frame(spark, block, key=2))
    moving = frame(spark, block, at=(-4, 7, 9)).union(frame(spark, block, key=2, at=(2, -6, -3)))
    moving = moving.where("z >= 0 and y >= 0 and x >= 0")
    packed = [store.from_voxels(f, KEYS, 8) for f in (fixed, moving)]
    got = {r.slice_id: (r.sx, r.sy, r.sz) for r in scores.coarse_to_fine(*packed, KEYS, 3, 3).collect()}
    assert got == {1: (9, 7, -4), 2: (-3, -6, 2)}
    alone = scores.translation_ncc_chunks(*packed, KEYS, [(-3, 3)] * 3).collect()
    assert all((r.sx, r.sy, r.sz) != got[r.slice_id] for r in alone)


def test_halved_chunks_are_means_of_present_voxels(spark):
    rnd = np.random.default_rng(1)
    block = rnd.integers(0, 50, (11, 7, 12)) * (rnd.random((11, 7, 12)) < 0.5)
    got = {(r.z, r.y, r.x): r.v for r in store.to_voxels(scores.halve(store.from_voxels(frame(spark, block), KEYS, 4), KEYS)).collect()}
    want = {}
    for (z, y, x), v in np.ndenumerate(block):
        if v:
            want.setdefault((z // 2, y // 2, x // 2), []).append(int(v))
    assert got == {k: int(np.floor(np.mean(v) + 0.5)) for k, v in want.items()}


def test_what_is_shuffled_does_not_follow_the_number_of_shifts(spark):
    block = smooth_block(5, 16)
    packed = store.from_voxels(frame(spark, block), KEYS, 8).withColumns({f"b{a}": F.lit(0) for a in "xyz"})
    near = scores.halo_pieces(packed, KEYS, [(-1, 1)] * 3)
    voxels = near.agg(F.sum(F.length("data") / 2)).first()[0]
    # 27 shifts; in the 4 x 4 x 4 chunks around, each voxel is met by its own chunk and by slabs of one voxel.
    assert voxels == 16**3 + (4 * 16 * 16) * 3 + (4 * 4 * 16) * 3 + 4**3


def test_values_on_a_log_scale_and_chunks_without_partner(spark):
    rnd = np.random.default_rng(8)
    a = rnd.integers(80, 4000, (8, 8, 8))
    fixed, moving = frame(spark, a), frame(spark, np.roll(a, 1, axis=2))
    packed = [store.from_voxels(f, KEYS, 4) for f in (fixed, moving)]
    value = lambda v: np.clip((np.log(np.maximum(v, 1)) - 4.6) * 39.4, 0, 255)
    got = scores.translation_ncc_chunks(*packed, KEYS, [(-1, 1)] * 3, value=value).first()
    logged = [f.withColumn("v", log_intensity(F.col("v"))) for f in (fixed, moving)]
    want = register.translation_ncc(*logged, KEYS, [(-1, 1)] * 3, 512).first()
    assert (got.sx, got.sy, got.sz) == (want.sx, want.sy, want.sz) == (1, 0, 0) and abs(got.ncc - want.ncc) < 1e-8
    far = store.from_voxels(frame(spark, a, at=(400, 0, 0)), KEYS, 4)
    assert scores.translation_ncc_chunks(packed[0], far, KEYS, [(-1, 1)] * 3).count() == 0
    assert scores.coarse_to_fine(packed[0].limit(0), packed[1], KEYS, 2, 1).count() == 0
