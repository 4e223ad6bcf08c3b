"""Displacement fields: rasterising, composing, lifting, inverting, and the brain built from them.

Fields are tables (keys, gy, gx, dx, dy[, dz]) on an integer grid.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.operators.geometry import _corners, euler_2d
from lamella.sources.cut import cut


def transform_to_field(grid: DataFrame, angle: float, shift: tuple[float, float], centre: tuple[float, float]) -> DataFrame:
    """D(p) = T(p) - p of a rotation and shift on grid points (keys, gy, gx)."""
    x, y = euler_2d(F.col("gx"), F.col("gy"), angle, *shift, *centre)
    return grid.withColumn("dx", x - F.col("gx")).withColumn("dy", y - F.col("gy"))


def compose_fields(first: DataFrame, second: DataFrame, keys: list[str], width: int, height: int) -> DataFrame:
    """D(p) = D2(p) + D1(p + D2(p)) on the grid of the second field; D1 is 0 outside its grid."""
    at = second.select(*keys, F.col("gy").alias("py"), F.col("gx").alias("px"), F.col("dx").alias("ex"), F.col("dy").alias("ey"))
    corners = _corners(at, F.col("px") + F.col("ex"), F.col("py") + F.col("ey"), width, height).where("_in and w > 0")
    sums = corners.join(first.select(*keys, "gy", "gx", "dx", "dy"), [*keys, "gy", "gx"]).groupBy(*keys, "py", "px").agg(F.sum(F.col("w") * F.col("dx")).alias("fx"), F.sum(F.col("w") * F.col("dy")).alias("fy"))
    out = at.join(sums, [*keys, "py", "px"], "left")
    return out.select(*keys, F.col("py").alias("gy"), F.col("px").alias("gx"), (F.col("ex") + F.coalesce("fx", F.lit(0.0))).alias("dx"), (F.col("ey") + F.coalesce("fy", F.lit(0.0))).alias("dy"))


def combine_xy_z(xy: DataFrame, z: DataFrame, keys: list[str], width: int, height: int) -> DataFrame:
    """3-D field of an xy field, applied first, and a z map (keys, gy, gx, dz) seen at p + xy; 0 outside."""
    corners = _corners(xy.select(*keys, F.col("gy").alias("py"), F.col("gx").alias("px"), "dx", "dy"), F.col("px") + F.col("dx"), F.col("py") + F.col("dy"), width, height).where("_in and w > 0")
    sums = corners.select(*keys, "py", "px", "gy", "gx", "w").join(z.select(*keys, "gy", "gx", "dz"), [*keys, "gy", "gx"]).groupBy(*keys, F.col("py").alias("gy"), F.col("px").alias("gx")).agg(F.sum(F.col("w") * F.col("dz")).alias("dz"))
    return xy.join(sums, [*keys, "gy", "gx"], "left").withColumn("dz", F.coalesce("dz", F.lit(0.0)))


def split_transforms(entries: DataFrame, nonrigid: bool = True) -> DataFrame:
    """(slice_id, xy_u, xy_l, z_u, z_l) of entries (key 'n,xy|z,u|l', path); rigid alignments take l for u."""
    part = F.split("key", ",")
    cells = entries.select(part[0].cast("int").alias("slice_id"), F.concat_ws("_", part[1], part[2]).alias("kind"), "path")
    pick = lambda k: F.max(F.when(F.col("kind") == k, F.col("path"))).alias(k)
    out = cells.groupBy("slice_id").agg(*[pick(k) for k in ("xy_u", "xy_l", "z_u", "z_l")])
    return out if nonrigid else out.withColumn("xy_u", F.col("xy_l")).withColumn("z_u", F.col("z_l"))


def build_brain(fields: DataFrame, slices: DataFrame, pixel: float, thickness: float, width: int, height: int) -> tuple[DataFrame, DataFrame]:
    """(slices, field) in micrometres of pixel fields (slice_id, plane, gy, gx, dx, dy, dz)."""
    low = slices.select("slice_id", *[F.col(f"lo_{a}").alias(f"s_{a}") for a in "xyz"])
    df = fields.join(F.broadcast(low), "slice_id")  # one row a slice
    depth = (F.col("slice_id") - 1 + F.col("plane")) * F.lit(thickness)
    field = df.select("slice_id", "plane", "gy", "gx", (F.col("dx") * pixel + F.col("s_x")).alias("dx"), (F.col("dy") * pixel + F.col("s_y")).alias("dy"), (F.col("dz") * pixel + F.col("s_z") - depth).alias("dz"))
    i = F.col("slice_id")
    box = [F.lit(0.0).alias("lo_x"), F.lit(0.0).alias("lo_y"), ((i - 1) * F.lit(thickness)).alias("lo_z"), F.lit(width * pixel).alias("hi_x"), F.lit(height * pixel).alias("hi_y"), (i * F.lit(thickness)).alias("hi_z")]
    return fields.select("slice_id").distinct().select("slice_id", *box), field


#: Field nodes along the side of a tile, nodes beyond it on each side, and points in a group.
TILE, HALO, GROUP_POINTS = 128, 2, 20_000
#: Most tiles whose keys are sent to all tasks; beyond it the tiles of a round are found by a shuffle.
SENT_KEYS = 100_000


def field_tiles(fields: DataFrame, tile: int = TILE) -> DataFrame:
    """(slice_id, ty, tx, nodes, h, w, oy, ny, ox, nx): tiles of a field with ``HALO`` nodes around, nodes as (plane, gy, gx, dx, dy, dz).

    h and w are the nodes of the slice's whole grid; absent nodes are zero.
    """
    nodes = fields.select("slice_id", *[F.col(c).cast("int").alias(c) for c in ("plane", "gy", "gx")], *[F.coalesce(f"d{a}", F.lit(0.0)).alias(f"d{a}") for a in "xyz"])
    grids = nodes.groupBy("slice_id").agg((F.max("gy") + 1).alias("h"), (F.max("gx") + 1).alias("w"))
    for a in "yx":
        low, high = (F.floor((F.col(f"g{a}") + o) / tile).cast("int") for o in (-HALO, HALO))
        nodes = nodes.withColumn(f"t{a}", F.explode(F.sequence(F.greatest(low, F.lit(0)), F.greatest(high, F.lit(0)))))
    packed = nodes.groupBy("slice_id", "ty", "tx").agg(F.collect_list(F.struct("plane", "gy", "gx", "dx", "dy", "dz")).alias("nodes"))
    packed = packed.join(grids, "slice_id").where((F.col("ty") * tile < F.col("h")) & (F.col("tx") * tile < F.col("w")))
    for a, n in (("y", "h"), ("x", "w")):
        packed = packed.withColumn(f"o{a}", F.greatest(F.col(f"t{a}") * tile - HALO, F.lit(0)))
        packed = packed.withColumn(f"n{a}", F.least((F.col(f"t{a}") + 1) * tile + HALO, F.col(n)) - F.col(f"o{a}"))
    return packed


def _flat(column: pa.ListArray) -> tuple[np.ndarray, list[pa.Array]]:
    """The row of each element of an array-of-structs column, and the fields of the elements."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), counts), column.flatten().flatten()


class _Tiles:
    """Tiles of fields, one a row: the map p + D(p) of points p on the tiles t, and where it can be looked up."""

    def __init__(self, rows: pa.RecordBatch, pixel: float, thickness: float, tile: int, extended: bool):
        self.pixel, self.thickness, self.tile, self.extended = pixel, thickness, tile, extended
        number = lambda c: pc.fill_null(rows.column(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.h, self.w, self.oy, self.ox, self.ny, self.nx, self.ty, self.tx = map(number, ("h", "w", "oy", "ox", "ny", "nx", "ty", "tx"))
        self.top = (number("slice_id") - 1) * thickness
        sizes = 2 * self.ny * self.nx
        self.first = np.cumsum(sizes) - sizes
        t, (plane, gy, gx, *moves) = _flat(rows.column("nodes"))
        plane, gy, gx, *moves = (c.to_numpy(zero_copy_only=False) for c in (plane, gy, gx, *moves))
        self.d = np.zeros((int(sizes.sum()), 3))
        self.d[self.first[t] + (plane * self.ny[t] + gy - self.oy[t]) * self.nx[t] + gx - self.ox[t]] = np.stack(moves, 1)

    def __call__(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        gx, gy, u = p[:, 0] / self.pixel, p[:, 1] / self.pixel, (p[:, 2] - self.top[t]) / self.thickness
        h, w, ny, nx = self.h[t], self.w[t], self.ny[t], self.nx[t]
        inside = self.extended | ((gx >= -0.5) & (gx < w - 0.5) & (gy >= -0.5) & (gy < h - 0.5) & (u >= -0.5) & (u < 1.5))
        level = np.clip(u, 0, 1)[:, None]
        gy, gx = (np.clip(np.clip(g, 0, whole - 1) - o, 0, n - 1) for g, whole, o, n in ((gy, h, self.oy[t], ny), (gx, w, self.ox[t], nx)))
        y0, x0 = np.floor(gy).astype(int), np.floor(gx).astype(int)
        y1, x1 = np.minimum(y0 + 1, ny - 1), np.minimum(x0 + 1, nx - 1)
        fy, fx = (gy - y0)[:, None], (gx - x0)[:, None]

        def seen(plane: int) -> np.ndarray:
            low, high = (self.first[t] + (plane * ny + y) * nx for y in (y0, y1))
            return (self.d[low + x0] * (1 - fx) + self.d[low + x1] * fx) * (1 - fy) + (self.d[high + x0] * (1 - fx) + self.d[high + x1] * fx) * fy

        move = seen(0) * (1 - level)
        if level.any():
            move += seen(1) * level
        return p + move * inside[:, None]

    def place(self, p: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tile numbers of positions; those beyond the grid belong to its border."""
        cell = lambda v, n: np.clip(np.floor(v / self.pixel), 0, n[t] - 1).astype(int) // self.tile
        return cell(p[:, 1], self.h), cell(p[:, 0], self.w)

    def covers(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether a look-up at p and at p + 0.01 stays within the tile and one node around it."""
        out = np.ones(len(p), bool)
        for v, n, at in ((p[:, 1], self.h[t], self.ty[t]), (p[:, 0], self.w[t], self.tx[t])):
            g = np.clip(v / self.pixel, 0, n - 1)
            out &= (g >= at * self.tile - 1) & (g < (at + 1) * self.tile + 1)
        return out


def slice_to_brain(points: DataFrame, fields: DataFrame, pixel: float, thickness: float, steps: int = 100, accuracy: float = 0.001, tile: int = TILE, group_points: int = GROUP_POINTS) -> DataFrame:
    """Brain positions of slice points (point_id, slice_id, x, y, z), by fixed-point steps on the slice's field.

    From (x, y, top of the slice): p becomes p - D d / 0.013 a step with D = f(p) - target and
    d = f(p + 0.01) - f(p), until |D| < ``accuracy`` on all axes or ``steps`` steps.
    """

    def step(f: Callable, p: np.ndarray, now: np.ndarray, off: np.ndarray) -> np.ndarray:
        return p - off * (f(p + 0.01) - now) / 0.013

    out = _invert(points, fields, pixel, thickness, steps, accuracy, tile, group_points, step, False)
    return out.select("point_id", "slice_id", "bx", "by", "bz", "converged", "steps", "residual")


def _invert(points: DataFrame, fields: DataFrame, pixel: float, thickness: float, steps: int, accuracy: float, tile: int, group_points: int, step: Callable, extended: bool) -> DataFrame:
    """Positions (bx, by, bz) that the field of their slice moves to the points, by ``step(f, p, f(p), f(p) - target)``.

    Points iterate with the tile of the field that they stand on. Those that leave it are keyed
    to the next tile and go on there, round by round until none is left; each round takes every
    point one step at least. Only tiles with points are shuffled, and one is copied only where
    more than ``group_points`` points stand on it, once for each group that these are cut into.
    A row is a tile with a group of points, and all rows of an Arrow batch iterate together.
    Without a field a point stays and is not converged. Repeated ids are points of their own.
    ``extended`` fields go on beyond their border with its values, others end there.
    """
    kind, slice_kind = (points.schema[c].dataType.simpleString() for c in ("point_id", "slice_id"))
    tiles = cut(field_tiles(fields, tile))
    grids = tiles.groupBy("slice_id").agg(F.first("h").alias("h"), F.first("w").alias("w"))
    at = lambda c, n: F.floor(F.least(F.greatest(F.floor(F.col(c) / pixel), F.lit(0)), F.col(n) - 1) / tile).cast("int")
    known = points.select("point_id", "slice_id", *[F.col(a).cast("double").alias(f"q{a}") for a in "xyz"]).join(grids, "slice_id", "left")
    start = known.select("point_id", "slice_id", "qx", "qy", "qz", F.col("qx").alias("bx"), F.col("qy").alias("by"), F.when(F.col("h").isNull(), F.col("qz")).otherwise((F.col("slice_id") - 1) * F.lit(thickness)).alias("bz"), at("qy", "h").alias("ty"), at("qx", "w").alias("tx"), F.lit(False).alias("converged"), F.lit(0).alias("steps"), F.lit(float("inf")).alias("residual"), F.col("h").isNotNull().alias("active"))
    columns = ["point_id", "slice_id", "qx", "qy", "qz", "bx", "by", "bz", "ty", "tx", "converged", "steps", "residual", "active"]
    schema = f"point_id {kind}, slice_id {slice_kind}, qx double, qy double, qz double, bx double, by double, bz double, ty int, tx int, converged boolean, steps int, residual double, active boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = _Tiles(batch, pixel, thickness, tile, extended)
            own, (ids, *values) = _flat(batch.column("pts"))
            qx, qy, qz, bx, by, bz, taken, residual = (v.to_numpy(zero_copy_only=False) for v in values)
            target, p = np.stack((qx, qy, qz), 1), np.stack((bx, by, bz), 1)
            done, taken, residual, held = np.zeros(len(p), bool), taken.copy(), residual.copy(), f.ny[own] > 0
            live = np.flatnonzero(held)
            while len(live):
                t = own[live]
                now = f(p[live], t)
                off = now - target[live]
                residual[live] = np.abs(off).max(axis=1)
                near = residual[live] < accuracy
                done[live[near]] = True
                go = ~near & (taken[live] + 1 < steps)
                p[live[go]] = step(partial(f, t=t[go]), p[live[go]], now[go], off[go])
                taken[live[go]] += 1
                live = live[go]
                live = live[f.covers(p[live], own[live])]
            ty, tx = (v.astype(np.int32) for v in f.place(p, own))
            left = held & ~done & (taken + 1 < steps)
            arrays = [ids, batch.column("slice_id").take(pa.array(own)), *map(pa.array, (qx, qy, qz, p[:, 0], p[:, 1], p[:, 2], ty, tx, done, taken, residual, left))]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    key = ["slice_id", "ty", "tx"]
    point = F.struct("point_id", "qx", "qy", "qz", "bx", "by", "bz", "steps", "residual")
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    active, finished = cut(start), []
    while True:
        finished.append(active.where("not active"))
        active = active.where("active")
        held = cut(active.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / group_points).cast("int").alias("parts")))
        n = held.count()
        if not n:
            break
        # At most one row for each ``group_points`` points, and points come from a written table, so a repeated task deals them out alike.
        crowded = F.broadcast(held.where("parts > 1"))
        dealt = active.join(crowded, key, "left").withColumn("part", F.floor(F.rand(1) * F.coalesce("parts", F.lit(1))).cast("int"))
        groups = dealt.groupBy(*key, "part").agg(F.collect_list(point).alias("pts"))
        spread = tiles.join(F.broadcast(held) if n <= SENT_KEYS else held, key).select(*tiles.columns, parts)
        active = cut(groups.join(spread, [*key, "part"], "left").mapInArrow(run, schema))
    out = finished[0]
    for more in finished[1:]:
        out = out.union(more)
    return out


def invert_field(fields: DataFrame, steps: int = 200, accuracy: float = 1e-7, tile: int = TILE, group_points: int = GROUP_POINTS) -> DataFrame:
    """(slice_id, plane, gy, gx, dx, dy, converged, residual): inverse displacement of each field on its own grid.

    For a node q the steps p = q - D(p) find the p that the field moves to q; the inverse is
    p - q. D goes on beyond the grid with its border's values. Nodes iterate on tiles, as
    points do in ``slice_to_brain``.
    """
    # A plane of a slice is a field of its own, numbered so that nothing else is needed.
    own = F.col("slice_id") * 2 + F.col("plane")
    flat = fields.select(own.alias("slice_id"), F.lit(0).alias("plane"), "gy", "gx", "dx", "dy", F.lit(0.0).alias("dz"))
    nodes = fields.select(F.lit(0).alias("point_id"), own.alias("slice_id"), F.col("gx").alias("x"), F.col("gy").alias("y"), (own - 1).cast("double").alias("z"))
    found = _invert(nodes, flat, 1.0, 1.0, steps, accuracy, tile, group_points, lambda f, p, now, off: p - off, True)
    whole = lambda c: F.round(c, 0).cast("int")
    kind = fields.schema["slice_id"].dataType
    return found.select(F.floor(F.col("slice_id") / 2).cast(kind).alias("slice_id"), (F.col("slice_id") % 2).cast("int").alias("plane"), whole("qy").alias("gy"), whole("qx").alias("gx"), (F.col("bx") - F.col("qx")).alias("dx"), (F.col("by") - F.col("qy")).alias("dy"), "converged", "residual")
