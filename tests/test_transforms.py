import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.operators import transforms as tf
from lamella.sources import manifest


def weights(t):
    return [(1 - t) ** 3 / 6, (3 * t**3 - 6 * t**2 + 4) / 6, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6, t**3 / 6]


def loop_spline(p, nodes, origin, spacing, direction=None):
    """``nodes`` is an array (component, [z,] y, x)."""
    dims = nodes.ndim - 1
    away = np.array(p[:dims]) - origin
    if direction is not None:
        away = np.array(direction).reshape(dims, dims).T @ away
    u, size = away / spacing, nodes.shape[:0:-1]
    if any(v < 1 or v > n - 2 for v, n in zip(u, size, strict=True)):
        return list(p)
    out = list(p)
    first = [min(math.floor(v), n - 3) - 1 for v, n in zip(u, size, strict=True)]
    w = [weights(v - c - 1) for v, c in zip(u, first, strict=True)]
    for k in np.ndindex(*[4] * dims):
        weight = math.prod(w[a][k[a]] for a in range(dims))
        for c in range(dims):
            out[c] += weight * nodes[(c, *[first[a] + k[a] for a in reversed(range(dims))])]
    return out


def rotated(p, angles, shift, centre):
    rx, ry, rz = (np.array(m) for m in (
        [[1, 0, 0], [0, math.cos(angles[0]), -math.sin(angles[0])], [0, math.sin(angles[0]), math.cos(angles[0])]],
        [[math.cos(angles[1]), 0, math.sin(angles[1])], [0, 1, 0], [-math.sin(angles[1]), 0, math.cos(angles[1])]],
        [[math.cos(angles[2]), -math.sin(angles[2]), 0], [math.sin(angles[2]), math.cos(angles[2]), 0], [0, 0, 1]],
    ))
    return rz @ rx @ ry @ (np.array(p) - centre) + np.array(centre) + shift


def points(spark, n=60):
    rnd = random.Random(3)
    rows = [(i, *[rnd.uniform(-10, 70) for _ in range(3)], "kept") for i in range(n)] + [(n, 10.0, 10.0, 10.0, "kept"), (n, 40.0, 40.0, 40.0, "kept")]
    return rows, spark.createDataFrame(rows, "point_id int, x double, y double, z double, note string")


def nodes_of(spark, nodes):
    dims = nodes.ndim - 1
    rows = [(*map(int, at), *[float(nodes[(c, *at)]) for c in range(dims)]) for at in np.ndindex(*nodes.shape[1:])]
    return spark.createDataFrame(rows, [f"i{a}" for a in "xyz"[:dims][::-1]] + [f"d{a}" for a in "xyz"[:dims]])


def compare(got, want):
    found = sorted((r.point_id, r.x, r.y, r.z) for r in got.collect())
    assert all(r.note == "kept" for r in got.collect())
    assert np.allclose(found, sorted(want), rtol=0, atol=1e-9)


def test_chain_of_rotation_affine_and_spline_equals_a_loop(spark):
    rows, df = points(spark)
    nodes = np.random.default_rng(1).normal(0, 5, (3, 5, 6, 7))
    origin, spacing = [-15.0, -10.0, -20.0], [15.0, 20.0, 30.0]
    angles, shift, centre = (0.2, -0.1, 0.3), (1.0, 2.0, -3.0), (20.0, 25.0, 30.0)
    params = [1.1, 0.1, 0, 0, 0.9, 0.05, 0.02, 0, 1, 1, -2, 3]
    stages = [{"kind": "euler3d", "angles": angles, "shift": shift, "centre": centre}, {"kind": "affine", "params": params}, {"kind": "bspline", "nodes": nodes_of(spark, nodes), "size": [7, 6, 5], "origin": origin, "spacing": spacing}]
    want = []
    for i, *p, _ in rows:
        q = rotated(p, angles, shift, centre)
        q = np.array(params[:9]).reshape(3, 3) @ q + params[9:]
        want.append((i, *loop_spline(q.tolist(), nodes, origin, spacing)))
    compare(tf.apply_transforms(df, stages), want)
    moved = sum(abs(a - b) > 1e-6 for r, w in zip(rows, want, strict=True) for a, b in zip(r[1:4], w[1:], strict=True))
    assert moved > 50


def test_spline_in_the_plane_with_direction_ends_and_missing_nodes(spark):
    rows, df = points(spark)
    nodes = np.random.default_rng(2).normal(0, 3, (2, 6, 6))
    origin, spacing, c, s = [-5.0, 0.0], [12.0, 10.0], math.cos(0.3), math.sin(0.3)
    direction = [c, -s, s, c]
    edge = [(100, -5.0 + 12 * c * u - 10 * s * v, 12 * s * u + 10 * c * v, 1.0, "kept") for u in (1.0, 3.999999999, 4.0) for v in (1.0, 4.0)]
    rows, df = rows + edge, df.union(spark.createDataFrame(edge, df.schema))
    stage = {"kind": "bspline", "nodes": nodes_of(spark, nodes), "size": [6, 6], "origin": origin, "spacing": spacing, "direction": direction}
    inner = [r for r in rows if r[0] != 100]
    compare(tf.apply_transforms(df.where("point_id <> 100"), [stage]), [(i, *loop_spline(p, nodes, origin, spacing, direction)) for i, *p, _ in inner])
    holed = stage | {"nodes": nodes_of(spark, nodes).where("not (ix = 0 and iy = 0)")}
    still = {(r.point_id, r.x) for r in tf.apply_transforms(df, [holed]).collect()}
    first = [r for r in rows if all(1 <= v < 2 for v in (np.array(direction).reshape(2, 2).T @ (np.array(r[1:3]) - origin)) / spacing)]
    assert all((r[0], r[1]) in still for r in first)


def test_keyed_grids_and_rows_without_a_grid(spark):
    nodes = {1: np.full((2, 4, 4), 3.0), 2: np.full((2, 4, 4), -1.0)}
    table = nodes_of(spark, nodes[1]).withColumn("slice_id", F.lit(1)).union(nodes_of(spark, nodes[2]).withColumn("slice_id", F.lit(2)))
    df = spark.createDataFrame([(s, 15.0, 15.0, 0.0) for s in (1, 2, 3)] + [(None, 15.0, 15.0, 0.0)], "slice_id int, x double, y double, z double")
    stage = {"kind": "bspline", "nodes": table, "keys": ["slice_id"], "size": [4, 4], "origin": [0.0, 0.0], "spacing": [10.0, 10.0]}
    got = {r.slice_id: round(r.x, 9) for r in tf.apply_transforms(df, [stage]).collect()}
    assert got == {1: 18.0, 2: 14.0, 3: 15.0, None: 15.0}


def test_chain_is_read_from_parameter_files(spark, tmp_path):
    rows, df = points(spark)
    nodes = np.random.default_rng(5).normal(0, 4, (3, 4, 5, 6)).round(6)
    listed = " ".join(str(v) for v in nodes.ravel())
    (tmp_path / "0.txt").write_text('(Transform "EulerTransform")\n(FixedImageDimension 3)\n(TransformParameters 0.1 0.2 -0.1 1 2 3)\n(CenterOfRotationPoint 5 6 7)\n(InitialTransformParametersFileName "NoInitialTransform")\n')
    (tmp_path / "1.txt").write_text(f'(Transform "BSplineTransform")\n(FixedImageDimension 3)\n(GridSize 6 5 4)\n(GridSpacing 16 20 50)\n(GridOrigin -16 -20 -60)\n(GridDirection 1 0 0 0 1 0 0 0 1)\n(BSplineTransformSplineOrder 3)\n(TransformParameters {listed})\n(InitialTransformParametersFileName "a")\n')
    files = spark.createDataFrame([("a", (tmp_path / "0.txt").read_text()), ("b", (tmp_path / "1.txt").read_text())], "path string, json string")
    stages = tf.chain_of(manifest.read_params(files), "b")
    assert [s["kind"] for s in stages] == ["euler3d", "bspline"]
    want = []
    for i, *p, _ in rows:
        q = rotated(p, (0.1, 0.2, -0.1), (1, 2, 3), (5, 6, 7)).tolist()
        want.append((i, *loop_spline(q, nodes, [-16, -20, -60], [16, 20, 50])))
    compare(tf.apply_transforms(df, stages), want)
    own = spark.createDataFrame([("c", '(Transform "AffineTransform")\n(FixedImageDimension 2)\n(TransformParameters 1 0 0 1 4 5)\n(InitialTransformParametersFileName "c")')], "path string, json string")
    with pytest.raises(ValueError):
        tf.chain_of(manifest.read_params(own), "c")


def test_blocks_of_many_cells_with_absent_and_repeated_nodes(spark):
    rnd, size, origin, spacing = random.Random(7), [10, 6, 9], [-10.0, -20.0, -15.0], [10.0, 25.0, 12.0]
    nodes = {k: np.random.default_rng(i).normal(0, 4, (3, *size[::-1])) for i, k in enumerate("ab")}
    table = nodes_of(spark, nodes["a"]).withColumn("key", F.lit("a")).union(nodes_of(spark, nodes["b"]).withColumn("key", F.lit("b")))
    gone, twice = (4, 3, 5), (8, 1, 9)
    here = lambda at: F.struct("key", "iz", "iy", "ix") == F.struct(F.lit("a"), *[F.lit(v).cast("long") for v in at])
    table = table.where(~here(gone)).union(table.where(here(twice))).withColumn("dy", F.when(~((F.col("key") == "b") & (F.col("iz") == 8)), F.col("dy")))
    table = table.union(table.where("ix = 0 and iy = 0 and iz = 0").withColumns({"ix": F.lit(-1).cast("long")}))
    nodes["a"][:, *gone] = nodes["a"][:, *twice] = nodes["b"][1, 8] = np.nan
    rows = [(i, *[rnd.uniform(o + s * 0.5, o + s * (n - 1.5)) for o, s, n in zip(origin, spacing, size, strict=True)], rnd.choice("ab")) for i in range(400)]
    stage = {"kind": "bspline", "nodes": table.repartition(3), "keys": ["key"], "size": size, "origin": origin, "spacing": spacing}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        got = {r.point_id: (r.x, r.y, r.z) for r in tf.apply_transforms(spark.createDataFrame(rows, "point_id int, x double, y double, z double, key string"), [stage]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    stayed = 0
    for i, *p, key in rows:
        want = loop_spline(p, nodes[key], origin, spacing)
        if any(map(math.isnan, want)):
            want = [o if math.isnan(w) else w for o, w in zip(p, want, strict=True)]
            stayed += 1
        assert np.allclose(got[i], want, rtol=0, atol=1e-9), (i, key)
    assert len(got) == 400 and 20 < stayed < 300


def test_nodes_and_points_are_shuffled_once_and_a_node_to_few_blocks(spark):
    nodes = nodes_of(spark, np.random.default_rng(4).normal(0, 4, (3, 4, 8, 8))).withColumn("key", F.col("iz") % 1)
    _, df = points(spark)
    stage = {"kind": "bspline", "nodes": nodes, "keys": ["key"], "size": [8, 8, 4], "origin": [-15.0, -15.0, -50.0], "spacing": [12.0, 12.0, 50.0]}
    plan = tf.apply_transforms(df.withColumn("key", (F.col("point_id") % 1).cast("long")), [stage])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "BroadcastHashJoin" not in plan
    copies = tf.spline_blocks(nodes, ["key"], [8, 8, 4]).select(F.size("_nodes").alias("n")).agg(F.sum("n")).first()[0]
    assert copies < 2 * 8 * 8 * 4
