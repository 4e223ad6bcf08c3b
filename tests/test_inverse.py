import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.operators import fields, geometry

PIXEL, THICK = 10.0, 30.0


def waves(n, slices=(1, 2)):
    """Smooth fields with a drift that takes points across tiles."""
    rows = []
    for s in slices:
        for plane in (0, 1):
            for y in range(n):
                for x in range(n):
                    rows.append((s, plane, y, x, 25.0 + 6 * np.sin(x / 3 + s), -18.0 + 5 * np.cos(y / 4 + plane), 2.0 * plane))
    return rows


def lookup(d, p, s, n):
    """p + D(p) by a loop."""
    gx, gy, u = p[0] / PIXEL, p[1] / PIXEL, (p[2] - (s - 1) * THICK) / THICK
    if not (-0.5 <= gx < n - 0.5 and -0.5 <= gy < n - 0.5 and -0.5 <= u < 1.5):
        return np.array(p)
    gx, gy, u = min(max(gx, 0), n - 1), min(max(gy, 0), n - 1), min(max(u, 0), 1)
    x0, y0 = int(gx), int(gy)
    out = np.array(p)
    for plane, wz in ((0, 1 - u), (1, u)):
        for y, wy in ((y0, 1 - gy + y0), (min(y0 + 1, n - 1), gy - y0)):
            for x, wx in ((x0, 1 - gx + x0), (min(x0 + 1, n - 1), gx - x0)):
                out = out + wz * wy * wx * d[(s, plane, y, x)]
    return out


def loop(d, q, s, n, steps=100, accuracy=0.001):
    p = np.array([q[0], q[1], (s - 1) * THICK])
    for k in range(steps):
        now = lookup(d, p, s, n)
        off = now - q
        if np.abs(off).max() < accuracy:
            return p, True, k
        if k + 1 < steps:
            p = p - off * (lookup(d, p + 0.01, s, n) - now) / 0.013
    return p, False, steps - 1


@pytest.mark.parametrize(("tile", "group"), [(128, 200_000), (3, 200_000), (4, 5)])
def test_points_across_tiles_equal_a_loop(spark, tile, group):
    n = 16
    rows = waves(n)
    d = {r[:4]: np.array(r[4:]) for r in rows}
    field = spark.createDataFrame([tuple(float(v) if i > 3 else v for i, v in enumerate(r)) for r in rows], "slice_id int, plane int, gy int, gx int, dx double, dy double, dz double")
    rnd = np.random.default_rng(4)
    pts = [(i, 1 + i % 2, float(rnd.uniform(30, 150)), float(rnd.uniform(0, 120)), float((i % 2) * THICK + rnd.uniform(3, 28))) for i in range(60)]
    pts += [(7, 1, 80.0, 60.0, 10.0)] * 8 + [(99, 5, 1.0, 2.0, 3.0), (98, 1, 4000.0, -900.0, 5.0)]
    points = spark.createDataFrame(pts, "point_id long, slice_id int, x double, y double, z double").repartition(3)
    got = sorted(map(tuple, fields.slice_to_brain(points, field, PIXEL, THICK, tile=tile, group_points=group).collect()))
    assert len(got) == len(pts)
    want = []
    for i, s, x, y, z in pts:
        if s == 5:
            want.append((i, s, x, y, z, False, 0))
        else:
            p, ok, k = loop(d, np.array([x, y, z]), s, n)
            want.append((i, s, *p, ok, k))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and a[5:7] == b[5:7] and np.allclose(a[2:5], b[2:5], atol=1e-7)
    assert sum(w[5] for w in want) > 60


def test_only_crowded_tiles_are_copied(spark):
    n = 16
    field = spark.createDataFrame([tuple(float(v) if i > 3 else v for i, v in enumerate(r)) for r in waves(n, (1,))], "slice_id int, plane int, gy int, gx int, dx double, dy double, dz double")
    tiles = fields.field_tiles(field, 8)
    held = {(r.ty, r.tx): (r.oy, r.ox, r.ny, r.nx, r.h, r.w) for r in tiles.collect()}
    assert held == {(0, 0): (0, 0, 10, 10, 16, 16), (0, 1): (0, 6, 10, 10, 16, 16), (1, 0): (6, 0, 10, 10, 16, 16), (1, 1): (6, 6, 10, 10, 16, 16)}


def test_no_points_and_no_field(spark):
    field = spark.createDataFrame([], "slice_id int, plane int, gy int, gx int, dx double, dy double, dz double")
    points = spark.createDataFrame([(1, 1, 2.0, 3.0, 4.0)], "point_id long, slice_id int, x double, y double, z double")
    got = fields.slice_to_brain(points, field, PIXEL, THICK).collect()
    assert [(r.bx, r.by, r.bz, r.converged) for r in got] == [(2.0, 3.0, 4.0, False)]
    assert fields.slice_to_brain(points.limit(0), field, PIXEL, THICK).count() == 0


def test_inverse_field_on_tiles_undoes_the_field(spark):
    y, x = np.mgrid[:20, :20]
    dx, dy = 0.8 * np.sin(x / 6), 0.6 * np.cos(y / 7)
    rows = [(3, plane, int(b), int(a), float(dx[b, a]), float(dy[b, a])) for plane in (0, 1) for b in range(20) for a in range(20)]
    field = spark.createDataFrame(rows, "slice_id int, plane int, gy int, gx int, dx double, dy double")
    results = []
    for tile in (128, 6):
        inverse = fields.invert_field(field, tile=tile)
        assert inverse.where("converged").count() == 800
        results.append({tuple(r[c] for c in ("slice_id", "plane", "gy", "gx")): (r.dx, r.dy) for r in inverse.collect()})
    assert all(np.allclose(results[0][k], results[1][k], atol=1e-6) for k in results[0])
    back = geometry.apply_field(inverse.where("plane = 0 and gy between 3 and 16 and gx between 3 and 16").select("gy", "gx", F.lit(1).alias("slice_id"), (F.col("gx") + F.col("dx")).alias("x"), (F.col("gy") + F.col("dy")).alias("y"), F.lit(0.0).alias("z")), field.where("plane = 0").withColumn("slice_id", F.lit(1)).withColumn("dz", F.lit(0.0)), 1.0, 20, 20, 1.0)
    assert all(abs(r.qx - r.gx) < 1e-5 and abs(r.qy - r.gy) < 1e-5 for r in back.collect())


def test_tiles_of_a_field_with_gaps_are_whole_and_packed_by_spark(spark):
    rows = [(1, plane, 0, x, 1.0, 0.0, 0.0) for plane in (0, 1) for x in (0, 1, 2, 3, 4, 5, 11)]
    tiles = fields.field_tiles(spark.createDataFrame(rows, "slice_id int, plane int, gy int, gx int, dx double, dy double, dz double"), 4)
    # Nodes 6 to 9 are absent and zero; a tile that ends with its last node would repeat that one's values.
    assert {(r.ty, r.tx): (r.oy, r.ox, r.ny, r.nx) for r in tiles.collect()} == {(0, 0): (0, 0, 1, 6), (0, 1): (0, 2, 1, 8), (0, 2): (0, 6, 1, 6)}
    assert "Pandas" not in tiles._jdf.queryExecution().toString()
