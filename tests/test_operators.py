import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.functions import kernels
from lamella.operators import chunks, fields, geometry, register, surface, volume
from lamella.plans import catalog
from lamella.sources import manifest, store

DATA = "/root/testdata/sf0.001"
FAST = ["max_projection", "locate_slice", "locate_column", "apply_field", "pending_products", "is_background", "quantize", "plan_blocks", "fill_blank", "fill_outside", "compose_fields", "surface_pairs", "slab_projection", "mosaic", "resample_chunks", "warp_chunks", "sphere_map_field", "energy_blend", "blend_tiles_middle", "blend_tiles_average"]


def _value(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, name):
    df = catalog.queries()[name](spark, DATA)
    names = sorted(df.columns)
    con = duckdb.connect()
    for t in ("lineitem", "orders", "nation", "supplier", "embeddings", "part"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.sql(catalog.oracle_sql()[name])
    at = [want.columns.index(c) for c in names]
    assert sorted(want.columns) == names
    assert sorted(tuple(_value(r[c]) for c in names) for r in df.collect()) == sorted(tuple(_value(r[i]) for i in at) for r in want.fetchall())


def test_slice_to_brain_inverts_the_field(spark):
    field = spark.range(64).select(F.lit(1).alias("slice_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("plane"), F.floor(F.col("id") / 8).cast("int").alias("gy"), (F.col("id") % 8).cast("int").alias("gx"), F.lit(7.0).alias("dx"), F.lit(-3.0).alias("dy"), F.lit(0.0).alias("dz"))
    points = spark.range(40).select(F.col("id").alias("point_id"), F.lit(1).alias("slice_id"), (F.col("id") * 10 + 100.0).alias("x"), (F.col("id") * 5 + 100.0).alias("y"), F.lit(50.0).alias("z"))
    back = fields.slice_to_brain(points, field, 100.0, 300.0)
    again = geometry.apply_field(back.select("point_id", "slice_id", F.col("bx").alias("x"), F.col("by").alias("y"), F.col("bz").alias("z")), field, 100.0, 8, 8, 300.0).join(points.select("point_id", F.col("x").alias("ox"), F.col("y").alias("oy")), "point_id")
    rows = again.collect()
    assert len(rows) == 40 and all(r.converged for r in back.collect())
    for r in rows:
        assert abs(r.qx - r.ox) < 1e-3 and abs(r.qy - r.oy) < 1e-3


def test_translation_recovers_a_shift(spark):
    rnd = np.random.default_rng(4)
    block = rnd.integers(1, 1000, (8, 8, 8))
    rows = [(1, int(z), int(y), int(x), int(v)) for (z, y, x), v in np.ndenumerate(block)]
    fixed = spark.createDataFrame(rows, "slice_id int, z int, y int, x int, v int")
    moved = fixed.select("slice_id", (F.col("z") + 1).alias("z"), (F.col("y") - 1).alias("y"), F.col("x").alias("x"), "v")
    got = register.translation_ncc(fixed, moved, ["slice_id"], [(-1, 1)] * 3, 512).first()
    assert (got.sx, got.sy, got.sz) == (0, -1, 1) and got.ncc > 0.999


def test_chunks_round_trip_and_lazy_brain(spark, tmp_path):
    rows = [("a", 0, 1, 2, 5), ("a", 9, 9, 9, 70000), ("b", 3, 3, 3, 0)]
    voxels = spark.createDataFrame(rows, "volume string, z int, y int, x int, v int")
    back = store.to_voxels(store.from_voxels(voxels, ["volume"], 4)).collect()
    assert sorted(map(tuple, back)) == [("a", 0, 1, 2, 5), ("a", 9, 9, 9, 65535)]
    slices = spark.createDataFrame([(1,), (2,)], "slice_id int")
    store.write_brain(slices, slices.withColumn("dx", F.lit(1.0)), str(tmp_path))
    one = store.read_brain(spark, str(tmp_path), 2)
    assert one[0].count() == one[1].count() == 1
    assert "PartitionFilters: [isnotnull(slice_id" in one[1]._jdf.queryExecution().executedPlan().toString()


def test_params_and_points_files(spark, tmp_path):
    (tmp_path / "p.txt").write_text('(Metric "NCC")\nplain line\n//(K 1)\n(K 2 3)\n//(Z 9)\n')
    (tmp_path / "q.txt").write_text("point\n3\n1 2 3\n4 5 6\n\n7 8 9\n")
    files = manifest.read_json_files(spark, str(tmp_path / "p.txt"))
    assert {r.key: r["values"] for r in manifest.read_params(files).collect()} == {"Metric": ["NCC"], "K": ["2", "3"], "Z": ["9"]}
    assert {r.key for r in manifest.read_params(files, True).collect()} == {"Metric", "K"}
    points = manifest.read_points(manifest.read_json_files(spark, str(tmp_path / "q.txt"))).collect()
    assert [(r.x, r.y, r.z) for r in sorted(points, key=lambda r: r.point_id)] == [(1, 2, 3), (4, 5, 6)]


def test_edges_of_columns_and_slices(spark):
    boxes = spark.createDataFrame([(1, 0, 0.0, 10.0, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0])], "slice_id int, column_id int, lo_y double, hi_y double, params array<double>")
    points = spark.createDataFrame([(1, 1, 0.0, -5.0, 0.0), (2, 1, 0.0, 50.0, 0.0), (3, 9, 0.0, 5.0, 0.0)], "point_id int, slice_id int, x double, y double, z double")
    assert {r.point_id: r.column_id for r in geometry.locate_column(points, boxes).collect()} == {1: 0, 2: 0, 3: None}
    gap = spark.createDataFrame([(1, 0.0), (2, 300.0), (4, 900.0)], "slice_id int, lo_z double")
    z = spark.createDataFrame([(1, -5.0), (2, 0.0), (3, 700.0), (4, 5000.0)], "point_id int, z double")
    assert {r.point_id: r.slice_id for r in geometry.locate_slice(z, gap).collect()} == {1: 1, 2: 1, 3: 2, 4: 4}


def test_results_do_not_depend_on_partitions(spark):
    v = spark.range(600).select((F.col("id") % 2).cast("int").alias("slice_id"), (F.col("id") % 10).cast("int").alias("z"), (F.col("id") % 7).cast("int").alias("y"), (F.col("id") % 5).cast("int").alias("x"), (F.col("id") % 300).cast("int").alias("v")).dropDuplicates(["slice_id", "z", "y", "x"])
    v = v.cache()
    a, b = (sorted(map(tuple, surface.fill_blank(v.repartition(n), ["slice_id"]).select("slice_id", "z", "y", "x", "v").collect())) for n in (1, 7))
    assert a == b and surface.fill_blank(v.limit(0), ["slice_id"]).count() == 0


def test_repeated_points_and_missing_slices(spark):
    field = spark.range(64).select(F.lit(1).alias("slice_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("plane"), F.floor(F.col("id") / 8).cast("int").alias("gy"), (F.col("id") % 8).cast("int").alias("gx"), F.lit(7.0).alias("dx"), F.lit(-3.0).alias("dy"), F.lit(0.0).alias("dz"))
    points = spark.createDataFrame([(1, 1, 50.0, 60.0, 70.0), (1, 1, 50.0, 60.0, 70.0), (1, 1, 9e9, 60.0, 70.0), (2, None, 1.0, 1.0, 1.0)], "point_id int, slice_id int, x double, y double, z double")
    got = geometry.apply_field(points, field, 100.0, 8, 8, 300.0).collect()
    assert sorted((r.point_id, r.qx - r.x, r.qy - r.y) for r in got) == [(1, 0.0, 0.0), (1, 7.0, -3.0), (1, 7.0, -3.0), (2, 0.0, 0.0)]
    boxes = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0, 100.0, 100.0, 100.0), (1, 1, 40.0, 0.0, 0.0, 200.0, 100.0, 100.0)], "slice_id int, column_id int, lo_x double, lo_y double, lo_z double, hi_x double, hi_y double, hi_z double")
    two = spark.createDataFrame([(5, 1, 20.0, 50.0, 50.0), (5, 1, 150.0, 50.0, 50.0), (5, 1, 500.0, 50.0, 50.0)], "point_id int, slice_id int, x double, y double, z double")
    assert {r.x: r.column_id for r in geometry.locate_column_strict(two, boxes).collect()} == {20.0: 0, 150.0: 1, 500.0: None}
    none = boxes.limit(0)
    for find in (geometry.locate_slice, geometry.locate_slice_strict):
        assert [r.slice_id for r in find(two.drop("slice_id"), none).collect()] == [None] * 3


def test_boxes_of_all_sizes_match_brute_force(spark):
    rnd = np.random.default_rng(6)
    make = lambda n: [(int(k), *map(float, np.concatenate((lo := rnd.uniform(-50, 50, 3), lo + rnd.choice([0.0, 0.5, 9.0, 300.0]) * rnd.uniform(-1, 1, 3))))) for k in range(n)]
    cols = [f"{e}_{x}" for e in ("lo", "hi") for x in "xyz"]
    schema = "id int, " + ", ".join(f"{c} double" for c in cols)
    a, b = make(60), [*make(60), (99, None, *[0.0] * 5)]
    low, high = (lambda r: [min(r[k], r[k + 3]) for k in (1, 2, 3)]), (lambda r: [max(r[k], r[k + 3]) for k in (1, 2, 3)])
    want = sorted((x[0], y[0]) for x in a for y in b[:-1] if all(p <= s and q <= t for p, q, s, t in zip(low(x), low(y), high(y), high(x))))
    got = geometry.boxes_overlapping(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 4.0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50
    upright = spark.createDataFrame([(r[0], *low(r), *high(r)) for r in a], schema)
    points = spark.createDataFrame([(k, *map(float, rnd.uniform(-60, 60, 3))) for k in range(200)], "point_id int, x double, y double, z double")
    held = geometry.box_contains(points, upright, 4.0)
    assert "Cartesian" not in held._jdf.queryExecution().executedPlan().toString()
    want = sorted((p.point_id, r[0]) for p in points.collect() for r in a if all(lo < v < hi for lo, v, hi in zip(low(r), (p.x, p.y, p.z), high(r))))
    assert sorted(map(tuple, held.collect())) == want and want
    assert geometry.box_contains(points, upright.limit(0), 4.0).count() == 0


def test_point_texts_are_bounded(spark):
    points = spark.range(25).select(F.col("id").alias("point_id"), *[(F.col("id") * k).cast("double").alias(x) for k, x in enumerate("xyz", 1)])
    texts = manifest.write_points(points, 10)
    assert sorted(r.json.split("\n")[1] for r in texts.collect()) == ["10", "10", "5"]
    back = manifest.read_points(texts).collect()
    assert sorted((int(r.path) * 10 + r.point_id, r.x) for r in back) == [(k, float(k)) for k in range(25)]


def _random_volume(spark, sizes):
    rnd = np.random.default_rng(11)
    full = [(1, int(z), int(y), int(x), int(rnd.integers(1, 70_000))) for z in range(sizes["z"]) for y in range(sizes["y"]) for x in range(sizes["x"]) if rnd.random() < 0.7]
    voxels = spark.createDataFrame(full, "slice_id int, z int, y int, x int, v int").withColumn("v", F.least("v", F.lit(65535)))
    grid = voxels.select("slice_id").distinct()
    for a in "zyx":
        grid = grid.withColumn(a, F.explode(F.sequence(F.lit(0), F.lit(sizes[a] - 1))))
    return voxels, grid


def _cells(df):
    return sorted((r.z, r.y, r.x, r.v) for r in df.where("v > 0").collect())


def test_chunk_resampling_matches_the_long_form(spark):
    sizes = {"x": 10, "y": 9, "z": 7}  # no multiples of the chunk's edge
    voxels, grid = _random_volume(spark, sizes)
    stored = store.from_voxels(voxels, ["slice_id"], 4)
    for params in ([0.8, -0.3, 0.0, 0.3, 0.8, 0.1, 0.0, -0.1, 1.2, 1.5, -2.0, 0.4], [1, 0, 0, 0, 1, 0, 0, 0, 1, 400, 0, 0], [-1, 0, 0, 0, -1, 0, 0, 0, -1, 9, 8, 6]):
        got = store.to_voxels(chunks.resample_chunks(stored, ["slice_id"], params, sizes, sizes, 4))
        assert _cells(got) == _cells(volume.resample_affine(grid, voxels, ["slice_id"], params, sizes))
    assert chunks.resample_chunks(stored.limit(0), ["slice_id"], params, sizes, sizes, 4).count() == 0


def test_chunk_warping_matches_the_long_form(spark):
    sizes = {"x": 10, "y": 9, "z": 7}
    voxels, grid = _random_volume(spark, sizes)
    rnd = np.random.default_rng(12)
    rows = [(1, p, y, x, *map(float, rnd.uniform(-60, 60, 3))) for p in (0, 1) for y in range(3) for x in range(4) if (y, x) != (1, 1)]
    field = spark.createDataFrame(rows, "slice_id int, plane int, gy int, gx int, dx double, dy double, dz double")
    points = grid.select(F.concat_ws(":", "z", "y", "x").alias("point_id"), "slice_id", "z", "y", "x")
    spacing = {"x": 20.0, "y": 20.0, "z": 30.0}
    at = points.select("point_id", "slice_id", *[(F.col(a) * spacing[a]).alias(a) for a in "xyz"])
    stored = store.from_voxels(voxels, ["slice_id"], 4)
    for used in (field, field.limit(0)):
        moved = geometry.apply_field(at, used, 50.0, 4, 3, 150.0).select("point_id", "qx", "qy", "qz")
        long = volume.warp_slice(points, voxels, moved, ["slice_id"], sizes, 20.0).withColumn("v", F.floor(F.round("v", 6) + 0.5).cast("int"))
        got = store.to_voxels(chunks.warp_chunks(stored, ["slice_id"], used, sizes, sizes, 4, spacing, 20.0, 50.0, 4, 3, 150.0))
        want = _cells(long)
        assert _cells(got) == want and want


def test_column_to_brain_inverts_the_way_there(spark):
    from lamella.plans import q_geometry, views

    # All points as they are, those near the border too; the registered query draws them inward.
    field, boxes = views.field(spark, DATA), q_geometry._boxes(spark, DATA)
    placed = geometry.locate_column(geometry.locate_slice(views.view(spark, DATA, "pts"), views.slices(spark)), boxes).where("column_id is not null")
    there = geometry.column_to_slice(placed.select("point_id", "slice_id", "column_id", "px", "py", "frame"), boxes).select("point_id", "slice_id", "x", "y", "z")
    back = fields.slice_to_brain(there, field, 100.0, 300.0, tile=3)
    again = geometry.apply_field(back.where("converged").select("point_id", "slice_id", *[F.col(f"b{a}").alias(a) for a in "xyz"]), field, 100.0, 8, 8, 300.0)
    rows = again.select("point_id", "qx", "qy", "qz").join(there, "point_id").collect()
    assert len(rows) >= 0.99 * there.count()
    for r in rows:
        assert max(abs(r.qx - r.x), abs(r.qy - r.y), abs(r.qz - r.z)) < 1.1e-3


def test_invert_field_job_undoes_the_field(spark):
    y, x = np.mgrid[:12, :12]
    dx, dy = 0.8 * np.sin(y / 4) * np.sin(np.pi * x / 11), 0.6 * np.sin(x / 5) * np.sin(np.pi * y / 11)
    rows = [(s, p, i, j, float(dx[i, j] * (s + p)), float(dy[i, j] * (s + p))) for s in (1, 2) for p in (0, 1) for i in range(12) for j in range(12)]
    got = fields.invert_field(spark.createDataFrame(rows, "slice_id int, plane int, gy int, gx int, dx double, dy double")).toPandas()
    assert len(got) == len(rows) and got["converged"].all()
    for (s, p), part in got.groupby(["slice_id", "plane"]):
        at_y, at_x = part["gy"] + part["dy"], part["gx"] + part["dx"]
        there = [kernels.bilinear(d * (s + p), at_y.to_numpy(), at_x.to_numpy()) for d in (dx, dy)]
        assert np.abs(there[0] + part["dx"]).max() < 1e-5 and np.abs(there[1] + part["dy"]).max() < 1e-5


def test_as_of_join_beyond_one_row_of_slices(spark, monkeypatch):
    monkeypatch.setattr(geometry, "SMALL_ROWS", 60)
    monkeypatch.setattr(geometry, "CUT_ROWS", 7)
    rnd = np.random.default_rng(6)
    starts = np.concatenate([rnd.uniform(0, 1000, 290).round(1), [500.0] * 12])
    slices = spark.createDataFrame([(i, float(z)) for i, z in enumerate(starts)] + [(999, None)], "slice_id int, lo_z double")
    at = [*rnd.uniform(-50, 1050, 400).tolist(), *starts[:40].tolist(), 500.0, -1.0, 2000.0]
    points = spark.createDataFrame([(i, z) for i, z in enumerate(at)] + [(9999, None)], "point_id int, z double")
    got = {r.point_id: r.slice_id for r in geometry.locate_slice(points, slices).collect()}
    order = sorted((z, i) for i, z in enumerate(starts))
    want = {}
    for i, z in enumerate(at):
        begun = [s for s in order if s[0] <= z]
        want[i] = (begun[-1] if begun else order[0])[1]
    assert {k: v for k, v in got.items() if k != 9999} == want and len(got) == len(at) + 1
    monkeypatch.setattr(geometry, "SMALL_ROWS", 100_000)
    assert {r.point_id: r.slice_id for r in geometry.locate_slice(points, slices).collect()} == got
