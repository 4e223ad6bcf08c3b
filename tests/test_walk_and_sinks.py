import random

import numpy as np

from lamella.operators import register
from lamella.operators.select import BACKGROUND_SHARE, BACKGROUND_THRESHOLDS
from lamella.sources import store


def walk(pair, shares, ok):
    """The walk as it is told, one step after the other."""
    slice_id, column_id, _, _, z, n = pair
    tried = 0
    for k, threshold in enumerate(BACKGROUND_THRESHOLDS):
        c = 100 + min(z, 0)
        while c < n - 100 - min(-z, 0):
            if max(shares[(slice_id, column_id, c)][k]) > BACKGROUND_SHARE:
                c += 100
                continue
            tried += 1
            if ok.get((slice_id, column_id, c), False):
                return (slice_id, column_id, threshold, c, c - 100, c + 100, c - 100 - z, c + 100 - z, tried)
            c += 200
    return None


def test_windows_are_walked_with_background_and_failures(spark):
    rnd = random.Random(2)
    pairs = [(s, k, 5 + k, 11 - k, rnd.choice([-40, 0, 30]), rnd.choice([150, 700, 1200])) for s in range(1, 5) for k in (1, 2, 3)]
    frames = []
    for s in range(1, 5):
        for k in range(4):
            for frame in {c - z for _, _, _, _, z, n in pairs for c in range(100 + min(z, 0), n, 100)} | {c for _, _, _, _, z, n in pairs for c in range(100 + min(z, 0), n, 100)}:
                if rnd.random() < 0.9:
                    top = rnd.choice([110, 130, 220, 400, 900])
                    frames += [(s, k, frame, x, rnd.randrange(top)) for x in range(16)]
    ok = {(s, k, c): rnd.random() < 0.3 for s, k, _, _, z, n in pairs for c in range(100 + min(z, 0), n, 100) if rnd.random() < 0.8}
    table = spark.createDataFrame(frames, "slice_id int, column_id int, frame int, x int, v int")
    given = spark.createDataFrame(pairs, "slice_id int, column_id int, x1 int, x2 int, z_offset int, n_frames int")
    registered = spark.createDataFrame([(*k, v) for k, v in ok.items()], "slice_id int, column_id int, c int, ok boolean")
    shares = {}
    for s, k, x1, x2, z, n in pairs:
        for c in range(100 + min(z, 0), n, 100):
            share = lambda v, t: sum(0 <= i <= t for i in v) / len(v) if v else 1.0
            left = [v for a, b, f, x, v in frames if (a, b, f) == (s, k - 1, c) and x >= x1]
            right = [v for a, b, f, x, v in frames if (a, b, f) == (s, k, c - z) and x < x2]
            shares[(s, k, c)] = [(share(left, t), share(right, t)) for t in BACKGROUND_THRESHOLDS]
    want = [w for w in (walk(p, shares, ok) for p in pairs) if w]
    got = register.registration_windows(register.frame_shares(table, given), given, registered)
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
    upper = register.registration_windows(register.frame_shares(table, given), given, registered, symmetric=False).first()
    assert upper.stop_2 == upper.stop


def test_stitched_maps(spark):
    params = [0.0, 2.0, 0.0, 0.0, 0.0, 3.0, 0.5, 0.0, 0.25, 1.0, 2.0, 3.0]
    columns = spark.createDataFrame([(1, "1", k, params, 10.0 + k, 4.0) for k in range(4)], "slice_id int, channel_id string, column_id int, params array<double>, pos0_x double, raw_x double")
    est = spark.createDataFrame([(1, 1, 2.0, 3.0, 4.0, 0.5, 1), (1, 3, -1.0, 0.0, 5.0, 0.25, 2)], "slice_id int, column_id int, ex double, ey double, ez double, offset double, z_offset int")
    got = {r.column_id: r.params for r in register.stitched_affine(columns, est).collect()}
    first = (-2.0 - 0.5, -3.0, -4.0 - 1)
    both = (first[0] + 1.0 - 0.25, first[1], first[2] - 5.0 - 2)
    want = {0: (1.0, 2.0, 3.0 + 0.5 * 6), 1: (1.0 + first[0], 2.0 + first[1], 3.0 + 0.5 * 7 + first[2]), 2: (1.0, 2.0, 3.0), 3: (1.0 + both[0], 2.0 + both[1], 3.0 + 0.5 * 9 + both[2])}
    for k, t in want.items():
        assert got[k][:9] == params[:9] and np.allclose(got[k][9:], t)


def test_planes_are_written_and_read_alone(spark, tmp_path):
    rnd = np.random.default_rng(3)
    rows = [("a", int(z), int(y), int(x), int(rnd.integers(1, 65536))) for z, y, x in {tuple(v) for v in rnd.integers(0, 19, (300, 3)).tolist()}] + [("b", 2, 3, 4, 65535), ("b", 30, 0, 0, 7)]
    chunks = store.from_voxels(spark.createDataFrame(rows, "volume string, z int, y int, x int, v int"), ["volume"], 8)
    path = str(tmp_path / "planes")
    store.write_planes(chunks, path, ["volume"])
    assert sorted(map(tuple, store.planes_to_voxels(store.read_planes(spark, path), ["volume"]).collect())) == sorted(rows)
    some = store.read_planes(spark, path, first=2, last=5).where("volume = 'a'")
    assert sorted(map(tuple, store.planes_to_voxels(some, ["volume"]).collect())) == sorted(r for r in rows if r[0] == "a" and 2 <= r[1] <= 5)
    store.write_planes(chunks, path, ["volume"], quantized=True)
    assert {r.v for r in store.planes_to_voxels(store.read_planes(spark, path).where("volume = 'b'"), ["volume"]).collect()} == {65520}


def test_sphere_map_is_stored(spark, tmp_path):
    slices = spark.createDataFrame([(1,)], "slice_id int")
    store.write_brain(slices, slices.selectExpr("slice_id", "1.0D dx"), str(tmp_path), slices.selectExpr("slice_id", "true hit"))
    assert [tuple(r) for r in store.read_sphere_map(spark, str(tmp_path)).collect()] == [(1, True)]
