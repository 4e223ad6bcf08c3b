"""Chains of transforms on points: rotations in the plane and in space, affine maps, cubic B-splines.

A B-spline grid is a table of control nodes. A block of its cells becomes one row that holds all
nodes they need as arrays, so a node is copied to few rows, a point meets one row by an equi-join
on its block, and the tensor product of the weights is a sum along lines of nodes. Grids may be
keyed, so every slice can have one of its own. Points outside the valid region of a grid, or whose
cell lacks a node, stay where they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.operators.geometry import AXES, affine, euler_2d

#: Cells along the edge of a block, 3 at least.
BLOCK = 4
#: Keys of a parameter file that describe a transform and are a few numbers each.
_DESCRIPTION = ("Transform", "FixedImageDimension", "CenterOfRotationPoint", "InitialTransformParametersFileName", "GridSize", "GridSpacing", "GridOrigin", "GridDirection", "BSplineTransformSplineOrder")


def euler_3d_matrix(angles: tuple[float, float, float]) -> list[list[float]]:
    """Rotation about y first, then x, then z."""
    (cx, cy, cz), (sx, sy, sz) = map(math.cos, angles), map(math.sin, angles)
    return [
        [cz * cy - sz * sx * sy, -sz * cx, cz * sy + sz * sx * cy],
        [sz * cy + cz * sx * sy, cz * cx, sz * sy - cz * sx * cy],
        [-cx * sy, sx, cx * cy],
    ]


def euler_3d(x: Column, y: Column, z: Column, angles: tuple[float, float, float], shift: tuple[float, float, float], centre: tuple[float, float, float]) -> list[Column]:
    """A rotation about a centre, then a shift."""
    from_centre = [c - o for c, o in zip((x, y, z), centre, strict=True)]
    return [sum((m * p for m, p in zip(row, from_centre, strict=True)), F.lit(o + t)) for row, o, t in zip(euler_3d_matrix(angles), centre, shift, strict=True)]


def spline_weights(t: Column) -> list[Column]:
    """The four cubic weights of a position t in [0, 1] of a cell, as one chain of products."""
    s = 1 - t
    return [s * s * s / 6, (3 * t * t * t - 6 * t * t + 4) / 6, (3 * s * s * s - 6 * s * s + 4) / 6, t * t * t / 6]


def _edges(block: Column, size: list[int]) -> dict[str, tuple[Column, Column]]:
    """For each axis the first cell of a block and the nodes along the block."""
    out, under = {}, 1
    for a, n in zip(AXES, size, strict=False):
        count = max(0, n - 4) // BLOCK + 1
        first = F.floor(block / under) % count * BLOCK
        out[a] = (first, F.least(F.lit(BLOCK + 3), n - first))
        under *= count
    return out


def _first_line(edges: dict[str, tuple[Column, Column]]) -> list[Column]:
    """_at, the place in its block of the first node of a cell (_cx, _cy[, _cz]), and _sy[, _sz], the steps to the next line."""
    at, under, steps = F.lit(0), F.lit(1), []
    for a, (first, along) in edges.items():
        at = at + (F.col(f"_c{a}") - first) * under
        steps.append(under.cast("int").alias(f"_s{a}"))
        under = under * along
    return [at.cast("int").alias("_at"), *steps[1:]]


def _lines(axes: str) -> Column:
    """Places of the first nodes of the 4 (x 4) lines along x that a cell needs, y fastest."""
    starts = [F.col("_at")]
    for a in axes[1:]:
        starts = [s + F.col(f"_s{a}") * k for k in range(4) for s in starts]
    return F.array(*starts)


def spline_blocks(nodes: DataFrame, keys: list[str], size: list[int]) -> DataFrame:
    """(keys, _block, _nodes) of control nodes (keys, [iz,] iy, ix, dx, dy[, dz]): blocks of cells with all nodes they need, x fastest.

    A node goes to the blocks whose cells need it, two at most along an axis. The nodes of a block in an
    Arrow batch are one row before they are shuffled. Nodes that are absent, or there more than once, are null.
    """
    axes = AXES[: len(size)]
    index, values = [f"_i{a}" for a in axes], [f"d{a}" for a in axes]
    inside = [F.col(f"i{a}").between(0, n - 1) for a, n in zip(axes, size, strict=True)]
    df = nodes.where(reduce(Column.__and__, inside)).select(*keys, *[F.col(f"i{a}").cast("long").alias(f"_i{a}") for a in axes], *[F.col(v).cast("double").alias(v) for v in values])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, block, place, under, along = np.arange(batch.num_rows), np.int64(0), np.int64(0), 1, 1
            for name, n in zip(index, size, strict=True):
                i, last = batch.column(name).to_numpy()[rows], (n - 4) // BLOCK
                low, high = np.maximum(0, -((BLOCK + 2 - i) // BLOCK)), np.minimum(i // BLOCK, last)
                copies = np.maximum(0, high - low + 1)
                again = np.repeat(np.arange(len(rows)), copies)
                b = low[again] + np.arange(len(again)) - np.repeat(np.cumsum(copies) - copies, copies)
                rows, block, place, along = rows[again], np.broadcast_to(block, len(i))[again], np.broadcast_to(place, len(i))[again], np.broadcast_to(along, len(i))[again]
                block, place = block + b * under, place + (i[again] - b * BLOCK) * along
                under, along = under * (max(0, n - 4) // BLOCK + 1), along * np.minimum(BLOCK + 3, n - b * BLOCK)
            own = batch.select([*keys, *values]).take(pa.array(rows))
            table = pa.table([*own.columns, pa.array(block), pa.array(place.astype(np.int32))], [*keys, *values, "_block", "_place"])
            packed = table.group_by([*keys, "_block"], use_threads=False).aggregate([(c, "list") for c in ("_place", *values)])
            yield from packed.select([*keys, "_block", *[f"{c}_list" for c in ("_place", *values)]]).rename_columns([*keys, "_block", "_place", *values]).to_batches()

    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    packs = df.mapInArrow(pack, kinds + "_block long, _place array<int>, " + ", ".join(f"{v} array<double>" for v in values))
    # Shuffled before they are grouped: tasks that read the nodes then keep and sort none of them.
    whole = packs.repartition(*keys, "_block").groupBy(*keys, "_block").agg(F.collect_list(F.struct("_place", *values)).alias("_parts"))
    listed = F.sort_array(F.flatten(F.transform("_parts", lambda p: F.arrays_zip(*[p[c].alias(c) for c in ("_place", *values)]))))
    full = reduce(Column.__mul__, [m for _, m in _edges(F.col("_block"), size).values()]).cast("int")
    none = F.lit(None).cast("struct<_place: int, " + ", ".join(f"{v}: double" for v in values) + ">")

    def spread(node: Column, i: Column) -> Column:
        """The node, or null if it is not the only one, and nulls up to the next one."""
        place, after, before = node["_place"], F.coalesce(F.get("_listed", i + 1)["_place"], F.col("_full")), F.get("_listed", i - 1)["_place"]
        alone = F.when((place != after) & (before.isNull() | (before != place)), node)
        return F.when(place == after, F.array_repeat(none, 0)).otherwise(F.concat(F.array(alone), F.array_repeat(none, after - place - 1)))

    df = whole.select(*keys, "_block", listed.alias("_listed"), full.alias("_full"))
    complete = (F.size("_listed") == F.col("_full")) & (F.size(F.array_distinct("_listed._place")) == F.col("_full"))
    gaps = F.concat(F.array_repeat(none, F.col("_listed")[0]["_place"]), F.flatten(F.transform("_listed", spread)))
    return df.select(*keys, "_block", F.when(complete, F.col("_listed")).otherwise(gaps).alias("_nodes"))


def spline_cells(nodes: DataFrame, keys: list[str], size: list[int]) -> DataFrame:
    """(keys, [_cz,] _cy, _cx, _nodes): each cell with all its 4 x 4 (x 4) nodes, x fastest; taken from its block in place."""
    df, axes = spline_blocks(nodes, keys, size), AXES[: len(size)]
    edges = _edges(F.col("_block"), size)
    for a, n in zip(axes, size, strict=True):
        first = edges[a][0]
        df = df.withColumn(f"_c{a}", F.explode(F.sequence(first, F.least(first + BLOCK - 1, F.lit(n - 4)))))
    df = df.select("*", *_first_line(edges)).withColumn("_lines", _lines(axes))
    four = F.flatten(F.transform("_lines", lambda s: F.slice("_nodes", s + 1, 4)))
    return df.select(*keys, *[f"_c{a}" for a in axes[::-1]], four.alias("_nodes")).where(F.forall("_nodes", lambda n: n.isNotNull()))


def _continuous(dims: int, origin: list[float], spacing: list[float], direction: list[float] | None) -> list[Column]:
    """Grid position of a point; the columns of ``direction`` are unit vectors along the grid's axes."""
    away = [F.col(a) - o for a, o in zip(AXES[:dims], origin, strict=True)]
    if direction is None:
        return [p / s for p, s in zip(away, spacing, strict=True)]
    return [sum((away[r] * direction[dims * r + c] for r in range(dims)), F.lit(0.0)) / spacing[c] for c in range(dims)]


def bspline(points: DataFrame, nodes: DataFrame, keys: list[str], size: list[int], origin: list[float], spacing: list[float], direction: list[float] | None = None) -> DataFrame:
    """Points moved by a cubic B-spline grid of ``size`` nodes, with the first node at ``origin``; lists go x, y[, z]."""
    dims = len(size)
    axes, at = AXES[:dims], _continuous(dims, origin, spacing, direction)
    inside, block, under = F.lit(True), F.lit(0), 1
    first = {a: F.least(F.floor(f"_u{a}"), F.lit(n - 3)) - 1 for a, n in zip(axes, size, strict=True)}
    for a, n in zip(axes, size, strict=True):
        inside = inside & (F.col(f"_u{a}") >= 1) & (F.col(f"_u{a}") <= n - 2)
        block = block + F.floor(first[a] / BLOCK) * under
        under *= max(0, n - 4) // BLOCK + 1
    if min(size) < 4:
        inside = F.lit(False)
    place = {f"_u{a}": u for a, u in zip(axes, at, strict=True)}
    df = points.withColumns(place).select(*points.columns, F.when(inside, block).alias("_block"))
    blocks = spline_blocks(nodes, keys, size)
    blocks = blocks.select(*keys, "_block", *[F.col(f"_nodes.d{a}").alias(f"_d{a}") for a in axes])
    # Grids with keys can be many, and as arrays larger than the planner takes them for.
    df = df.join(blocks.hint("merge") if keys else blocks, [*keys, "_block"], "left")
    # What a point needs of its place is made again here and not shuffled.
    own = [*points.columns, *[f"_d{a}" for a in axes]]
    df = df.withColumns(place).select(*own, "_block", *place, *[F.when(F.col("_block").isNotNull(), first[a]).alias(f"_c{a}") for a in axes])
    df = df.select(*own, *_first_line(_edges(F.col("_block"), size)), *[(F.col(f"_u{a}") - F.col(f"_c{a}") - 1).alias(f"_t{a}") for a in axes])
    df = df.select(*own, _lines(axes).alias("_lines"), *[w.alias(f"_w{a}{k}") for a in axes for k, w in enumerate(spline_weights(F.col(f"_t{a}")))])

    weights, starts = [f"_w{a}{k}" for a in axes for k in range(4)], F.col("_lines")

    def four(axis: str, values: Column) -> Callable[[Column], Column]:
        w = [F.col(f"_w{axis}{k}") for k in range(4)]
        return lambda s: sum((w[k] * values[s + k] for k in range(1, 4)), w[0] * values[s])

    # Sums of four nodes along x, then of four of these along y (and z): a column each, so that none is made twice.
    for i, axis in enumerate(axes):
        sums = [F.transform(starts, four(axis, F.col(f"_d{a}"))).alias(f"_d{a}") for a in axes]
        df, starts = df.select(*points.columns, *weights, *sums), F.array(*[F.lit(k) for k in range(0, 4 ** (dims - i - 1), 4)])
    shift = {a: F.coalesce(F.col(f"_d{a}")[0], F.lit(0.0)) if a in axes else F.lit(0.0) for a in AXES}
    return df.select(*[(F.col(c) + shift[c]).alias(c) if c in shift else F.col(c) for c in points.columns])


def apply_transforms(points: DataFrame, stages: list[dict]) -> DataFrame:
    """Points (x, y, z) through a chain of stages, the first stage first.

    A stage is ``{"kind": "euler2d", angle, shift, centre}``, ``{"kind": "euler3d", angles,
    shift, centre}``, ``{"kind": "affine", params}`` with twelve numbers, or ``{"kind":
    "bspline", nodes, size, origin, spacing[, direction][, keys]}``. Stages in the plane leave z.
    """
    df = points
    for stage in stages:
        x, y, z = F.col("x"), F.col("y"), F.col("z")
        if stage["kind"] == "bspline":
            keys = stage.get("keys", [])
            df = bspline(df, stage["nodes"], keys, stage["size"], stage["origin"], stage["spacing"], stage.get("direction"))
            continue
        if stage["kind"] == "euler2d":
            new = [*euler_2d(x, y, stage["angle"], *stage["shift"], *stage["centre"]), z]
        elif stage["kind"] == "euler3d":
            new = euler_3d(x, y, z, stage["angles"], stage["shift"], stage["centre"])
        elif stage["kind"] == "affine":
            new = affine(F.array(*[F.lit(float(v)) for v in stage["params"]]), x, y, z)
        else:
            raise ValueError(f"unknown kind of transform: {stage['kind']}")
        df = df.select(*[c for c in df.columns if c not in AXES], *[n.alias(a) for n, a in zip(new, AXES, strict=True)])
    return df


def _nodes_of(params: DataFrame, size: list[int]) -> DataFrame:
    """Control nodes of a parameter list: all values of x, then of y (then of z), the first axis fastest."""
    dims, n = len(size), math.prod(size)
    cells = params.select(F.posexplode("values").alias("pos", "v")).select((F.col("pos") % n).alias("node"), F.floor(F.col("pos") / n).alias("c"), F.col("v").cast("double").alias("v"))
    node, places, under = F.col("node"), [], 1
    for a, k in zip(AXES, size, strict=False):
        places.append((F.floor(node / under) % k).alias(f"i{a}"))
        under *= k
    values = [F.max(F.when(F.col("c") == i, F.col("v"))).alias(f"d{a}") for i, a in enumerate(AXES[:dims])]
    return cells.groupBy("node").agg(*values).select(*places, *[f"d{a}" for a in AXES[:dims]])


def stage_of(params: DataFrame, path: str) -> tuple[dict, str]:
    """(stage, path of the initial transform) of one file of parsed parameters (path, key, values).

    The description, a dozen short lists, comes to the driver; the coefficients of a B-spline
    stay a table.
    """
    own = params.where(F.col("path") == path)
    told = {r["key"]: r["values"] for r in own.where(F.col("key").isin(*_DESCRIPTION)).collect()}
    numbers = lambda key: [float(v) for v in told[key]]
    kind, dims = told["Transform"][0], int(float(told["FixedImageDimension"][0]))
    values = own.where("key = 'TransformParameters'")
    before = told.get("InitialTransformParametersFileName", ["NoInitialTransform"])[0]
    if kind == "BSplineTransform":
        if int(float(told.get("BSplineTransformSplineOrder", ["3"])[0])) != 3:
            raise ValueError("only cubic B-splines are known")
        size = [int(v) for v in numbers("GridSize")]
        direction = numbers("GridDirection") if "GridDirection" in told else None
        return {"kind": "bspline", "nodes": _nodes_of(values, size), "size": size, "origin": numbers("GridOrigin"), "spacing": numbers("GridSpacing"), "direction": direction}, before
    given = [float(v) for v in values.first()["values"]]
    if kind == "EulerTransform" and dims == 2:
        return {"kind": "euler2d", "angle": given[0], "shift": tuple(given[1:3]), "centre": tuple(numbers("CenterOfRotationPoint"))}, before
    if kind == "EulerTransform" and dims == 3:
        return {"kind": "euler3d", "angles": tuple(given[:3]), "shift": tuple(given[3:6]), "centre": tuple(numbers("CenterOfRotationPoint"))}, before
    if kind == "AffineTransform" and dims in (2, 3):
        if dims == 2:
            a, b, c, d, tx, ty = given
            given = [a, b, 0, c, d, 0, 0, 0, 1, tx, ty, 0]
        return {"kind": "affine", "params": given}, before
    raise ValueError(f"unknown transform: {kind} in {dims} dimensions")


def chain_of(params: DataFrame, path: str) -> list[dict]:
    """The stages of a file and of the initial transforms it names, in the order in which points go through them."""
    stages, seen = [], set()
    while path != "NoInitialTransform":
        if path in seen:
            raise ValueError(f"the transform {path} is its own initial transform")
        seen.add(path)
        stage, path = stage_of(params, path)
        stages.insert(0, stage)
    return stages
