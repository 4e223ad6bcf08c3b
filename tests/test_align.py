import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.operators import align, register

KEYS = ["slice_id"]


def blobs(seed, n=64, shift=(0.0, 0.0), angle=0.0, bend=None):
    """Smooth image sampled at moved places: value(p) is the base image at T(p)."""
    rnd = np.random.default_rng(seed)
    at = [(rnd.uniform(0, n, 2), rnd.uniform(40, 230), rnd.uniform(8, 60)) for _ in range(40)]
    y, x = np.mgrid[:n, :n].astype(float)
    c = (n - 1) / 2
    px, py = x - c, y - c
    qx = px * math.cos(angle) - py * math.sin(angle) + c + shift[0]
    qy = px * math.sin(angle) + py * math.cos(angle) + c + shift[1]
    if bend is not None:
        qx, qy = qx + bend(y, x)[0], qy + bend(y, x)[1]
    out = sum(a * np.exp(-((qy - p[0]) ** 2 + (qx - p[1]) ** 2) / w) for p, a, w in at)
    return np.clip(out, 0, 255).astype(int)


def rows(image, key=1, channel="1"):
    return [(key, channel, int(y), int(x), int(v)) for (y, x), v in np.ndenumerate(image)]


def frame(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], "slice_id int, channel string, y int, x int, v int")


@pytest.mark.parametrize("size", [4, 16])
def test_one_level_equals_long_form(spark, size):
    fixed = frame(spark, rows(blobs(1, 12)), rows(blobs(2, 12), channel="2"), rows(blobs(3, 12), key=2))
    moving = frame(spark, rows(blobs(1, 12, (1, -1))), rows(blobs(2, 12, (1, -1)), channel="2"), rows(blobs(4, 12), key=2))
    want = register.rigid_align(fixed, moving, KEYS, [-0.2, 0.0, 0.2], 2, (5.5, 5.5), 30)
    got = align.rigid_levels(align.tiles(fixed, KEYS, size), align.tiles(moving, KEYS, size), KEYS, 1, 0.2, 1, 2, (5.5, 5.5), 30)
    assert sorted((r.slice_id, r.k, r.sx, r.sy, round(r.mi, 6)) for r in got.collect()) == sorted((r.slice_id, r.k - 1, r.sx, r.sy, round(r.mi, 6)) for r in want.collect())


def test_levels_find_a_rotation_and_shift_past_one_level(spark):
    base, step = blobs(7), 0.02
    moved = blobs(7, shift=(-9.0, 6.0), angle=-0.16)  # undone by p -> R(0.16) p + about (9, -6) turned
    fixed, moving = (align.tiles(frame(spark, rows(i)), KEYS, 16) for i in (base, moved))
    centre = (31.5, 31.5)
    found = align.rigid_levels(fixed, moving, KEYS, 3, step, 3, 4, centre, 16, beam=4).first()
    assert abs(found.k * step - 0.16) <= step
    back = (9 * math.cos(0.16) + 6 * math.sin(0.16), 9 * math.sin(0.16) - 6 * math.cos(0.16))
    assert abs(found.sx - back[0]) <= 1 and abs(found.sy - back[1]) <= 1
    one = align.rigid_levels(fixed, moving, KEYS, 1, step, 3, 4, centre, 16).first()
    assert one.mi < 0.7 * found.mi


def test_warped_tiles_and_round_trip(spark):
    image = blobs(9, 20)
    packed = align.tiles(frame(spark, rows(image)), KEYS, 8)
    assert sorted(map(tuple, align.pixels(packed, KEYS).collect())) == rows(image)
    found = spark.createDataFrame([(1, 0, 3, -2)], "slice_id int, k int, sx int, sy int")
    seen = {(r.y, r.x): r.v for r in align.pixels(align.warp_tiles(packed, packed, KEYS, found, 0.1, (9.5, 9.5)), KEYS).collect()}
    assert seen == {(y, x): int(image[y - 2, x + 3]) for y in range(2, 20) for x in range(17)}


def test_halved_tiles(spark):
    image = blobs(3, 14)[:11, :14]
    got = {(r.y, r.x): r.v for r in align.pixels(align.halve_tiles(align.tiles(frame(spark, rows(image)), KEYS, 4), KEYS), KEYS).collect()}
    parts = {}
    for (y, x), v in np.ndenumerate(image):
        parts.setdefault((y // 2, x // 2), []).append(int(v))
    assert got == {k: int(np.floor(np.mean(v) + 0.5)) for k, v in parts.items()}


def test_local_shifts_equal_long_form(spark):
    fixed, moving = frame(spark, rows(blobs(5, 16)), rows(blobs(6, 16), key=2)), frame(spark, rows(blobs(5, 16, (1, 2))), rows(blobs(6, 16, (-2, 0)), key=2))
    want = register.nonrigid_align(fixed, moving, KEYS, 4, 2)
    none = spark.createDataFrame([(1, 0, 0, 0), (2, 0, 0, 0)], "slice_id int, k int, sx int, sy int")
    got = align.local_shifts(align.tiles(fixed, KEYS, 8), align.tiles(moving, KEYS, 8), KEYS, none, 0.1, (7.5, 7.5), 4, 2)
    assert sorted((r.slice_id, r.cy, r.cx, r.sx, r.sy) for r in got.collect()) == sorted((r.slice_id, r.cy, r.cx, r.sx, r.sy) for r in want.collect())


def test_dense_field_is_a_spline_of_the_cells(spark):
    rnd = np.random.default_rng(2)
    grid = rnd.normal(0, 2, (2, 3, 4))
    cells = spark.createDataFrame([(1, y, x, float(grid[0, y, x]), float(grid[1, y, x])) for y in range(3) for x in range(4)], "slice_id int, cy int, cx int, sx double, sy double")
    got = {(r.gy, r.gx): (r.dx, r.dy) for r in align.dense_field(cells, KEYS, 5, (14, 18)).collect()}
    assert len(got) == 14 * 18
    w = lambda t: [(1 - t) ** 3 / 6, (3 * t**3 - 6 * t**2 + 4) / 6, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6, t**3 / 6]
    for (y, x), d in got.items():
        u, v = (y + 0.5) / 5 - 0.5, (x + 0.5) / 5 - 0.5
        j, i = math.floor(u), math.floor(v)
        for c in range(2):
            want = sum(w(u - j)[b] * w(v - i)[a] * grid[c, min(max(j - 1 + b, 0), 2), min(max(i - 1 + a, 0), 3)] for b in range(4) for a in range(4))
            assert abs(d[c] - want) < 1e-9


def test_chain_brings_back_a_smooth_displacement(spark):
    n, keys = 64, KEYS
    # The following surface is the previous one bent: following(p + bend) looks like previous(p).
    bend = lambda y, x: (1.5 * np.sin(x / 20.0), 1.2 * np.cos(y / 22.0))
    truth = bend(*np.mgrid[:n, :n].astype(float))
    following = blobs(11, n)
    previous = blobs(11, n, bend=bend)
    packed = [align.tiles(frame(spark, p), keys, 16) for p in (rows(previous), rows(following))]
    empty = packed[0].limit(0)
    weights = spark.range(64).select(F.lit(1).alias("slice_id"), F.floor(F.col("id") / 8).cast("int").alias("cy"), (F.col("id") % 8).cast("int").alias("cx"), F.lit(0.4).alias("weight"))
    how = {"levels": 2, "step": 0.02, "turns": 1, "reach": 2, "bin_width": 16, "cell": 8, "local_reach": 3}
    got = align.align_surfaces(*packed, empty, keys, (n, n), penalties=weights, **how).collect()
    before = [r for r in got if r.side == "previous"]
    after = {(r.gy, r.gx): (r.dx, r.dy) for r in got if r.side == "following"}
    assert len(before) == len(after) == n * n and all(abs(r.dx) < 1e-9 and abs(r.dy) < 1e-9 for r in before)
    off = [abs(after[(y, x)][c] - truth[c][y, x]) for y in range(8, 56) for x in range(8, 56) for c in range(2)]
    assert np.mean(off) < 0.5
    still = align.align_surfaces(*packed, empty, keys, (n, n), nonrigid=False, **how).collect()
    assert {(r.gy, r.gx, r.dx, r.dy) for r in still if r.side == "following"} == {(r.gy, r.gx, r.dx, r.dy) for r in before}


def test_templates_and_missing_surfaces(spark):
    image, moved = blobs(13, 32), blobs(13, 32, (3.0, 1.0))
    previous = align.tiles(frame(spark, rows(moved), rows(moved, key=3)), KEYS, 16)
    following = align.tiles(frame(spark, rows(moved, key=2), rows(moved, key=3)), KEYS, 16)
    template = align.tiles(frame(spark, rows(image), rows(image, key=2)), KEYS, 16)
    how = {"levels": 2, "step": 0.02, "turns": 1, "reach": 3, "bin_width": 16, "cell": 16, "local_reach": 1, "nonrigid": False}
    got = align.align_surfaces(previous, following, template, KEYS, (32, 32), **how)
    sides = {(r.slice_id, r.side): (round(r.dx), round(r.dy), r.n) for r in got.groupBy("slice_id", "side").agg(F.avg("dx").alias("dx"), F.avg("dy").alias("dy"), F.count("*").alias("n")).collect()}
    # 1: previous to template; 2: no previous, so following to template; 3: no template, so previous to itself.
    assert sides == {(1, "previous"): (-3, -1, 1024), (2, "following"): (-3, -1, 1024), (3, "previous"): (0, 0, 1024), (3, "following"): (0, 0, 1024)}


def test_penalties_and_one_pass(spark):
    masks = spark.createDataFrame([(1, y, x, int(x < 4)) for y in range(4) for x in range(8)], "slice_id int, y int, x int, m int")
    got = {(r.cy, r.cx): r.weight for r in align.cell_penalties(masks, KEYS, 4, 0.2, 0.6).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {(0, 0): 0.6, (0, 1): 0.2}
    cells = spark.createDataFrame([(1, 0, 0, 1.0, 0.0), (1, 0, 1, 3.0, -2.0), (1, 5, 5, 7.0, 7.0)], "slice_id int, cy int, cx int, sx double, sy double")
    out = {(r.cy, r.cx): (round(r.sx, 9), round(r.sy, 9)) for r in align.smooth_penalised(cells, align.cell_penalties(masks, KEYS, 4, 0.2, 0.6), KEYS, 1).collect()}
    assert out == {(0, 0): (2.2, -1.2), (0, 1): (2.6, -1.6), (5, 5): (7.0, 7.0)}


def test_points_go_back_through_the_rigid_map(spark):
    points = spark.createDataFrame([(1, 10.0, 4.0, "a"), (1, 31.5, 24.0, "b"), (2, 7.0, 9.0, "c")], "slice_id int, px double, py double, name string")
    found = spark.createDataFrame([(1, 2, 3, -5, 0.0)], "slice_id int, k int, sx int, sy int, mi double")
    got = {r.name: (r.px, r.py) for r in align.points_before(points, found, KEYS, 0.1, (31.5, 24.0)).collect()}
    for name, want in (("a", (10.0, 4.0)), ("b", (31.5, 24.0))):
        x, y = got[name][0] - 31.5, got[name][1] - 24.0
        there = (x * math.cos(0.2) - y * math.sin(0.2) + 31.5 + 3, x * math.sin(0.2) + y * math.cos(0.2) + 24.0 - 5)
        assert there == pytest.approx(want, abs=1e-9)
    assert got["c"] == (7.0, 9.0)


def test_anchors_pull_the_search_over_levels(spark):
    """A flat image says nothing; the anchors alone name the map, on the coarse and on the fine level."""
    flat = frame(spark, [(k, "1", y, x, 100) for k in (1, 2) for y in range(16) for x in range(16)])
    images = align.tiles(flat, KEYS, 8)
    c, angle, shift = 7.5, 0.2, (3, -2)
    places = [(2.0, 3.0), (11.0, 4.0), (6.0, 13.0)]
    to = [((x - c) * math.cos(angle) - (y - c) * math.sin(angle) + c + shift[0], (x - c) * math.sin(angle) + (y - c) * math.cos(angle) + c + shift[1]) for x, y in places]
    anchors = spark.createDataFrame([(1, *p, *q) for p, q in zip(places, to, strict=True)], "slice_id int, px double, py double, qx double, qy double")
    got = align.rigid_levels(images, images, KEYS, 2, 0.1, 2, 2, (c, c), 30, 3, anchors, 1.0)
    found = {r.slice_id: r for r in got.collect()}
    assert (found[1].k, found[1].sx, found[1].sy) == (2, *shift) and found[1].mi == pytest.approx(0.0, abs=1e-6)
    # Without anchors all candidates are equal and the first of each level stands.
    assert found[2].mi == 0.0


def test_tiles_of_many_keys_are_worked_on_in_batches(spark):
    images = frame(spark, *[rows(blobs(k % 3 + 1, 8), key=k) for k in range(40)])
    packed = align.tiles(images, KEYS, 8)
    none = images.select("slice_id", F.lit(0).alias("k"), F.lit(0).alias("sx"), F.lit(0).alias("sy")).distinct()
    maps = none.groupBy("slice_id").agg(F.collect_list(F.struct("k", "sx", "sy")).alias("maps"))
    scores = align.rigid_scores(packed, packed, KEYS, maps, 0.1, (3.5, 3.5), 16)
    cells = align.local_shifts(packed, packed, KEYS, none, 0.1, (3.5, 3.5), 4, 1)
    for df in (packed, align.halve_tiles(packed, KEYS), scores, cells):
        assert "Pandas" not in df._jdf.queryExecution().toString()  # no call of Python for each tile
    assert len({(r.slice_id % 3, r.mi) for r in scores.collect()}) == 3
    assert [(r.sx, r.sy) for r in cells.collect()] == [(0.0, 0.0)] * 160


def test_local_shifts_shuffle_a_pixel_once_a_cell(spark):
    fixed, moving = frame(spark, rows(blobs(5, 12))), frame(spark, rows(blobs(5, 12, (1, 2))))
    got = register.nonrigid_align(fixed, moving, KEYS, 4, 2)
    assert "MapInArrow" in got._jdf.queryExecution().toString()
    a, b = blobs(5, 12), blobs(5, 12, (1, 2))
    for r in got.collect():
        means = {}
        for sy in range(-2, 3):
            for sx in range(-2, 3):
                at = [(y, x) for y in range(4 * r.cy, 4 * r.cy + 4) for x in range(4 * r.cx, 4 * r.cx + 4) if 0 <= y + sy < 12 and 0 <= x + sx < 12]
                means[round(float(np.mean([(a[p] - b[p[0] + sy, p[1] + sx]) ** 2 for p in at])), 6), abs(sx) + abs(sy), sx, sy] = None
        assert (r.sx, r.sy) == min(means)[2:]


def test_cells_are_packed_before_they_are_sorted(spark):
    rnd = np.random.default_rng(8)
    rows = [(k, y, x, int(rnd.integers(0, 50))) for k in range(30) for y in range(8) for x in range(8)]
    images = spark.createDataFrame(rows, "slice_id int, y int, x int, v int")
    got = register.nonrigid_align(images, images, ["slice_id"], 4, 2)
    assert all((r.sx, r.sy) == (0, 0) for r in got.collect()) and got.count() == 120
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan
