"""Placing columns, slices and points: affine maps, boxes, as-of, interval and range joins, fields.

An affine map is ``q = M p + t`` with twelve numbers: M by rows, then t. Tables of slices,
columns and boxes of one brain have a few thousand rows and are hinted for broadcast only
through ``small``, which counts them; beyond its bound the joins are bucketed by grid cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COS = math.cos(math.pi / 4)
TAN = math.tan(math.pi / 4)
AXES = "xyz"
#: Rows up to which a geometry table is broadcast.
SMALL_ROWS = 100_000
#: Slices in a cut of a larger table of them.
CUT_ROWS = 2_000


def small(df: DataFrame) -> DataFrame:
    """Hinted for broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def affine(params: Column, x: Column, y: Column, z: Column) -> list[Column]:
    """The three coordinates of M p + t."""
    p = (x, y, z)
    return [sum((params[3 * r + c] * p[c] for c in range(3)), params[9 + r]) for r in range(3)]


def invert_affine(params: Column) -> Column:
    """Parameters of the inverse map, by the adjugate."""
    m = lambda r, c: params[3 * r + c]
    cof = lambda r, c: m((r + 1) % 3, (c + 1) % 3) * m((r + 2) % 3, (c + 2) % 3) - m((r + 1) % 3, (c + 2) % 3) * m((r + 2) % 3, (c + 1) % 3)
    det = sum((m(0, c) * cof(0, c) for c in range(3)), F.lit(0.0))
    inv = [[cof(c, r) / det for c in range(3)] for r in range(3)]
    shift = [-sum((inv[r][c] * params[9 + c] for c in range(3)), F.lit(0.0)) for r in range(3)]
    return F.array(*[v for row in inv for v in row], *shift)


def column_bounds(columns: DataFrame) -> DataFrame:
    """Per column two corners and their box; the second corner counts all frames, as in the raw files."""
    s, n = F.col("spacing"), F.col("n_frames")
    ax, ay = F.col("stage_x") - F.floor(n / 2) * s, F.col("stage_y")
    bx, by, bz = F.col("stage_x") + n * s, F.col("stage_y") + F.col("pixel_size") * F.col("width"), COS * F.col("pixel_size") * F.col("height")
    a, b = (ax, ay, F.lit(0.0)), (bx, by, bz)
    corners = [c.alias(f"pos{k}_{x}") for k, p in enumerate((a, b)) for x, c in zip(AXES, p, strict=True)]
    box = [f(u, v).alias(f"{n}_{x}") for n, f in (("lo", F.least), ("hi", F.greatest)) for x, u, v in zip(AXES, a, b, strict=True)]
    return columns.select("*", *corners, *box)


def boxes_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest box around the boxes of a key."""
    return df.groupBy(*keys).agg(*[f(f"{n}_{x}").alias(f"{n}_{x}") for n, f in (("lo", F.min), ("hi", F.max)) for x in AXES])


def column_affine(bounds: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``params``: slice micrometres to (pixel x, pixel y, frame) of each column."""
    raw = boxes_of(bounds, keys).select(*keys, *[F.col(f"lo_{x}").alias(f"raw_{x}") for x in AXES])
    df = bounds.join(small(raw), keys)
    px, s = F.col("pixel_size"), F.col("spacing")
    zero = F.lit(0.0)
    m = [zero, 1 / px, zero, zero, zero, 1 / (px * COS), 1 / s, zero, 1 / (s * TAN)]
    start = F.when(s < 0, F.col("pos1_x")).otherwise(F.col("pos0_x"))
    d = [F.col("raw_x") - start, F.col("raw_y") - F.col("pos0_y"), F.col("raw_z") - F.col("pos0_z")]
    t = [sum((m[3 * r + c] * d[c] for c in range(3)), zero) for r in range(3)]
    return df.withColumn("params", F.array(*m, *t)).drop("raw_x", "raw_y", "raw_z")


def column_boxes(columns: DataFrame) -> DataFrame:
    """(keys, lo_*, hi_*) of columns with ``params``: the image corners taken back to slice space."""
    inv = columns.withColumn("inv", invert_affine(F.col("params")))
    corners = [affine(F.col("inv"), F.lit(0.0) if i == 0 else F.col("width") * 1.0, F.lit(0.0) if j == 0 else F.col("height") * 1.0, F.lit(0.0) if k == 0 else F.col("n_frames") * 1.0) for i in (0, 1) for j in (0, 1) for k in (0, 1)]
    return inv.select("slice_id", "channel_id", "column_id", "params", *[f(*[c[a] for c in corners]).alias(f"{n}_{x}") for n, f in (("lo", F.least), ("hi", F.greatest)) for a, x in enumerate(AXES)])


def slice_box(boxes: DataFrame, reference_channel: str | None = None) -> DataFrame:
    """Box of each (slice, channel); with a reference channel, of the reference for all."""
    own = boxes_of(boxes, ["slice_id", "channel_id"])
    if reference_channel is None:
        return own
    ref = own.where(F.col("channel_id") == reference_channel).drop("channel_id")
    return own.select("slice_id", "channel_id").join(ref, "slice_id")


def image_to_physical(p: Column, spacing: Column, origin: Column) -> Column:
    return p * spacing + origin


def physical_to_image(p: Column, spacing: Column, origin: Column) -> Column:
    return (p - origin) / spacing


def _inside(strict: bool) -> Column:
    low = [(F.col(f"lo_{x}") < F.col(x)) if strict else (F.col(f"lo_{x}") <= F.col(x)) for x in AXES]
    tests = [*low, *[F.col(x) < F.col(f"hi_{x}") for x in AXES]]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def locate_column_strict(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Lowest column of the point's slice whose box holds the point on all axes, ends excluded; null if none.

    Columns of a slice come as one array, so each point is one row, repeated ids included.
    """
    box = F.struct("column_id", *[f"{e}_{x}" for e in ("lo", "hi") for x in AXES])
    per = boxes.groupBy("slice_id").agg(F.sort_array(F.collect_list(box)).alias("_cs"))
    df = points.join(small(per), "slice_id", "left")
    p = {x: F.col(x) for x in AXES}
    holds = lambda c: (c["lo_x"] < p["x"]) & (p["x"] < c["hi_x"]) & (c["lo_y"] < p["y"]) & (p["y"] < c["hi_y"]) & (c["lo_z"] < p["z"]) & (p["z"] < c["hi_z"])
    hit = F.try_element_at(F.filter("_cs", holds), F.lit(1))["column_id"]
    return df.select(*points.columns, hit.alias("column_id"))


def locate_column(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Column by y only, with its affine image (px, py, frame).

    Column 0 up to its end; else the last beyond its start; else the lowest in between
    that begins at or before y and ends after it; null if none. Columns of a slice come as
    one array, so each point is one row and nothing is shuffled.
    """
    per = boxes.groupBy("slice_id").agg(F.sort_array(F.collect_list(F.struct("column_id", "lo_y", "hi_y", "params"))).alias("cs"))
    df = points.join(small(per), "slice_id", "left")
    first, last, y = F.element_at("cs", 1), F.element_at("cs", -1), F.col("y")
    found = F.when(y <= first["hi_y"], first).when(y > last["lo_y"], last).otherwise(F.try_element_at(F.filter("cs", lambda c: (c["column_id"] > first["column_id"]) & (c["column_id"] < last["column_id"]) & (c["lo_y"] <= y) & (y < c["hi_y"])), F.lit(1)))
    df = df.withColumn("c", found).drop("cs")
    px, py, frame = affine(F.col("c.params"), F.col("x"), F.col("y"), F.col("z"))
    return df.select(*points.columns, F.col("c.column_id").alias("column_id"), px.alias("px"), py.alias("py"), frame.alias("frame"))


def column_to_slice(points: DataFrame, columns: DataFrame) -> DataFrame:
    """Slice coordinates of (slice_id, column_id, px, py, frame)."""
    inv = small(columns.select("slice_id", "column_id", invert_affine(F.col("params")).alias("inv")))
    x, y, z = affine(F.col("inv"), F.col("px"), F.col("py"), F.col("frame"))
    return points.join(inv, ["slice_id", "column_id"]).select("*", x.alias("x"), y.alias("y"), z.alias("z")).drop("inv")


def _levels(df: DataFrame, cell: float) -> set[int]:
    """The size classes of boxes (lo_*, hi_*): powers of two of the cell, so a few dozen at most."""
    return {r[0] for r in df.select(_level(cell)).distinct().collect() if r[0] is not None}


def _level(cell: float) -> Column:
    extent = F.greatest(*[F.abs(F.col(f"hi_{x}") - F.col(f"lo_{x}")) for x in AXES])
    return F.greatest(F.ceil(F.log2(F.greatest(extent / cell, F.lit(1e-9)))), F.lit(0)).cast("int")


def _in_cells(df: DataFrame, low: dict[str, Column], high: dict[str, Column], cell: float) -> DataFrame:
    """Spread rows with a grid ``level`` over the cells that they touch; at their own level at most two on an axis."""
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))
    for x in AXES:
        df = df.withColumn(f"c{x}", F.explode(F.sequence(F.floor(low[x] / size), F.floor(high[x] / size))))
    return df


def boxes_overlapping(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """(a_id, b_id) of boxes that touch or overlap on all axes; ends may come in any order.

    Each size class has a grid of its own, whose cells are as large as its boxes, so that a
    long box touches few of them. Two boxes meet on the grid of the larger one, in x, y and
    z, and are kept in the cell that holds the lower corner of their intersection, so a pair
    comes once without a distinct. Boxes with a null end are in no pair.
    """
    levels = sorted(_levels(a, cell) | _levels(b, cell))

    def spread(df: DataFrame, side: str) -> DataFrame:
        lo = {x: F.least(f"lo_{x}", f"hi_{x}") for x in AXES}
        hi = {x: F.greatest(f"lo_{x}", f"hi_{x}") for x in AXES}
        own = _level(cell).alias(f"{side}level")
        whole = F.expr(" and ".join(f"{e}_{x} is not null" for e in ("lo", "hi") for x in AXES))
        df = df.where(whole).select(F.col("id").alias(f"{side}_id"), own, *[lo[x].alias(f"{side}lo_{x}") for x in AXES], *[hi[x].alias(f"{side}hi_{x}") for x in AXES])
        grids = F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda g: g >= F.col(f"{side}level"))
        return _in_cells(df.withColumn("level", F.explode(grids)), {x: F.col(f"{side}lo_{x}") for x in AXES}, {x: F.col(f"{side}hi_{x}") for x in AXES}, cell)

    both = spread(a, "a").join(spread(b, "b"), ["level", "cx", "cy", "cz"]).where(F.col("level") == F.greatest("alevel", "blevel"))
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))
    for x in AXES:
        both = both.where((F.col(f"alo_{x}") <= F.col(f"bhi_{x}")) & (F.col(f"blo_{x}") <= F.col(f"ahi_{x}")) & (F.col(f"c{x}") == F.floor(F.greatest(f"alo_{x}", f"blo_{x}") / size)))
    return both.select("a_id", "b_id")


def box_contains(points: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """(point_id, id) of boxes that hold a point, ends excluded: an equi-join by the cells of each size class of boxes."""
    levels = F.array(*map(F.lit, sorted(_levels(boxes, cell)))).cast("array<int>")
    at = {x: F.col(x) for x in AXES}
    spread = _in_cells(points.select("point_id", *AXES).withColumn("level", F.explode(levels)), at, at, cell)
    ends = [f"{e}_{x}" for e in ("lo", "hi") for x in AXES]
    placed = _in_cells(boxes.select("id", *ends, _level(cell).alias("level")), {x: F.col(f"lo_{x}") for x in AXES}, {x: F.col(f"hi_{x}") for x in AXES}, cell)
    return spread.join(placed, ["level", "cx", "cy", "cz"]).where(_inside(True)).select("point_id", "id")


def _one_row(slices: DataFrame, *columns: str) -> DataFrame:
    """The slices of a brain as one sorted array in a row to broadcast; their number is checked."""
    found = slices.select(*columns).limit(SMALL_ROWS + 1)
    row = found.agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(F.struct(*columns))).alias("_s"))
    too_many = F.raise_error(F.lit(f"a brain has more than {SMALL_ROWS} slices"))
    return F.broadcast(row.select(F.when(F.col("_n") > SMALL_ROWS, too_many).otherwise(F.col("_s")).alias("_s")))


def _begun(starts: Column, z: Column, start: Callable[[Column], Column]) -> Column:
    """How many entries of a sorted array begin at or below z, by halving steps: about seventeen looks for each point."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(SMALL_ROWS.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(start(F.try_element_at(starts, at + step)) <= z, at + step).otherwise(at))


def locate_slice(points: DataFrame, slices: DataFrame) -> DataFrame:
    """As-of join: the slice last begun at or below z; the first slice below all; null without slices.

    The starts of up to ``SMALL_ROWS`` slices come as one sorted array in one broadcast row, in
    which each point searches by halves. More of them are cut at quantiles of their starts, so
    that a point finds its cut the same way and meets one row with the slices of that cut by an
    equi-join. A slice without a start is in no place.
    """
    known = slices.where("lo_z is not null").select("lo_z", "slice_id")
    n = known.count()
    by_start = lambda s: s["lo_z"]
    if n <= SMALL_ROWS:
        df = points.join(_one_row(known, "lo_z", "slice_id"), F.lit(True))
        at = F.greatest(_begun(F.col("_s"), F.col("z"), by_start), F.lit(1))
        return df.withColumn("slice_id", F.try_element_at("_s", at)["slice_id"]).drop("_s")
    cuts = min(-(-n // CUT_ROWS), SMALL_ROWS)
    # Quantiles are starts of slices themselves, so a point past a cut has a slice begun within it.
    bounds = known.agg(F.array_distinct(F.percentile_approx("lo_z", [k / cuts for k in range(1, cuts)], 100 * cuts)).alias("_b"))
    cut_of = lambda df, z: df.join(F.broadcast(bounds), F.lit(True)).withColumn("_cut", _begun(F.col("_b"), F.col(z), lambda b: b)).drop("_b")
    held = cut_of(known, "lo_z").groupBy("_cut").agg(F.sort_array(F.collect_list(F.struct("lo_z", "slice_id"))).alias("_s"))
    df = cut_of(points, "z").join(held, "_cut", "left")
    at = F.greatest(_begun(F.col("_s"), F.col("z"), by_start), F.lit(1))
    return df.withColumn("slice_id", F.try_element_at("_s", at)["slice_id"]).drop("_s", "_cut")


def locate_slice_strict(points: DataFrame, slices: DataFrame) -> DataFrame:
    """First slice whose box [lo, hi) holds the point; the first slice of all if none; null without slices."""
    df = points.join(_one_row(slices, "slice_id", *[f"{e}_{x}" for e in ("lo", "hi") for x in AXES]), F.lit(True))
    p = {x: F.col(x) for x in AXES}
    holds = lambda b: (b["lo_x"] <= p["x"]) & (p["x"] < b["hi_x"]) & (b["lo_y"] <= p["y"]) & (p["y"] < b["hi_y"]) & (b["lo_z"] <= p["z"]) & (p["z"] < b["hi_z"])
    hit = F.try_element_at(F.filter("_s", holds), F.lit(1))["slice_id"]
    return df.withColumn("slice_id", F.coalesce(hit, F.try_element_at("_s", F.lit(1))["slice_id"])).drop("_s")


def _corners(df: DataFrame, gx: Column, gy: Column, width: int, height: int) -> DataFrame:
    """Four bilinear corners of each row with weight ``w``; a position in [-0.5, n - 0.5) is inside and clamps."""
    inside = (gx >= -0.5) & (gx < width - 0.5) & (gy >= -0.5) & (gy < height - 0.5)
    cx, cy = F.least(F.greatest(gx, F.lit(0.0)), F.lit(width - 1.0)), F.least(F.greatest(gy, F.lit(0.0)), F.lit(height - 1.0))
    df = df.withColumn("_in", inside).withColumn("_cx", cx).withColumn("_cy", cy)
    fx, fy = F.floor("_cx"), F.floor("_cy")
    wx, wy = F.col("_cx") - fx, F.col("_cy") - fy
    corner = lambda i, j: F.struct(F.least(fx + i, F.lit(width - 1)).cast("int").alias("gx"), F.least(fy + j, F.lit(height - 1)).cast("int").alias("gy"), ((wx if i else 1 - wx) * (wy if j else 1 - wy)).alias("w"))
    return df.withColumn("_k", F.explode(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)]))).select(*[c for c in df.columns if c not in ("_cx", "_cy")], "_k.*")


def field_cells(field: DataFrame) -> DataFrame:
    """(slice_id, cy, cx, d{axis}{plane}{j}{i}): the eight corners of each cell of a field in one row; absent corners are null."""
    corners = [F.struct((F.col("gy") - j).alias("cy"), (F.col("gx") - i).alias("cx"), F.lit(2 * j + i).alias("k")) for j in (0, 1) for i in (0, 1)]
    spread = field.select("slice_id", "plane", *[f"d{x}" for x in AXES], F.explode(F.array(*corners)).alias("c")).where("c.cy >= 0 and c.cx >= 0")
    at = lambda plane, k: (F.col("plane") == plane) & (F.col("c.k") == k)
    values = [F.max(F.when(at(p, 2 * j + i), F.col(f"d{x}"))).alias(f"d{x}{p}{j}{i}") for x in AXES for p in (0, 1) for j in (0, 1) for i in (0, 1)]
    return spread.groupBy("slice_id", F.col("c.cy").cast("long").alias("cy"), F.col("c.cx").cast("long").alias("cx")).agg(*values)


def apply_field(points: DataFrame, field: DataFrame, pixel: float, width: int, height: int, thickness: float) -> DataFrame:
    """Add (qx, qy, qz) = p + D(p) for points (point_id, slice_id, x, y, z).

    The field has plane 0 at the top (i - 1) t and plane 1 at i t of slice i: linear in
    between, bilinear in x and y. The corners of a cell are one row, so each point meets
    one row, is shuffled once and stays one row, repeated ids included. Outside the field,
    and where it has no value, a point stays.
    """
    u = (F.col("z") - (F.col("slice_id") - 1) * F.lit(thickness)) / thickness
    gx, gy = F.col("x") / pixel, F.col("y") / pixel
    inside = (gx >= -0.5) & (gx < width - 0.5) & (gy >= -0.5) & (gy < height - 0.5) & (u >= -0.5) & (u < 1.5)
    clamp = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), F.lit(float(top)))
    df = points.withColumns({"_x": clamp(gx, width - 1), "_y": clamp(gy, height - 1), "_u": clamp(u, 1), "_in": inside})
    df = df.withColumns({"cx": F.floor("_x"), "cy": F.floor("_y")})
    df = df.join(field_cells(field), ["slice_id", "cy", "cx"], "left")
    wx, wy, wz = F.col("_x") - F.col("cx"), F.col("_y") - F.col("cy"), F.col("_u")

    def shift(x: str) -> Column:
        parts = [(wz if p else 1 - wz) * (wy if j else 1 - wy) * (wx if i else 1 - wx) * F.coalesce(f"d{x}{p}{j}{i}", F.lit(0.0)) for p in (0, 1) for j in (0, 1) for i in (0, 1)]
        return F.when(F.col("_in"), sum(parts[1:], parts[0])).otherwise(0.0)

    return df.select(*points.columns, *[(F.col(x) + shift(x)).alias(f"q{x}") for x in AXES])


def brain_to_column(points: DataFrame, slices: DataFrame, field: DataFrame, boxes: DataFrame, pixel: float, width: int, height: int, thickness: float, strict: bool = False) -> DataFrame:
    """(point_id, slice_id, column_id, px, py, frame) of brain points: slice, field, then column."""
    placed = locate_slice(points, slices)
    moved = apply_field(placed, field, pixel, width, height, thickness)
    at = moved.select("point_id", "slice_id", *[F.col(f"q{x}").alias(x) for x in AXES])
    if not strict:
        return locate_column(at, boxes).select("point_id", "slice_id", "column_id", "px", "py", "frame")
    found = locate_column_strict(at, boxes).join(small(boxes.select("slice_id", "column_id", "params")), ["slice_id", "column_id"], "left")
    px, py, frame = affine(F.col("params"), F.col("x"), F.col("y"), F.col("z"))
    return found.select("point_id", "slice_id", "column_id", px.alias("px"), py.alias("py"), frame.alias("frame"))


def brain_box(slices: DataFrame) -> DataFrame:
    return slices.agg(*[f(f"{n}_{x}").alias(f"{n}_{x}") for n, f in (("lo", F.min), ("hi", F.max)) for x in AXES])


def sphere_map(box: DataFrame, voxel: int, mapper) -> DataFrame:
    """Grid of a brain box (ends excluded) mapped to (slice, column, int(frame)); zeros and ``hit`` false where unmatched."""
    grid = box
    for x in AXES:
        # x, y and z steps are exploded one inside the other: rows are made in place, nothing is joined.
        grid = grid.withColumn(x, F.explode(F.sequence(F.col(f"lo_{x}").cast("int"), F.col(f"hi_{x}").cast("int") - 1, F.lit(voxel))))
    grid = grid.select(F.concat_ws(":", "x", "y", "z").alias("point_id"), *[F.col(x).cast("double").alias(x) for x in AXES])
    out = grid.join(mapper(grid).select("point_id", "slice_id", "column_id", "frame"), "point_id")
    hit = F.col("column_id").isNotNull()
    return out.select(*[F.col(x).cast("int").alias(x) for x in AXES], F.when(hit, F.col("slice_id")).otherwise(0).alias("slice_id"), F.when(hit, F.col("column_id")).otherwise(0).alias("column_id"), F.when(hit, F.col("frame").cast("int")).otherwise(0).alias("frame"), hit.alias("hit"))


def euler_2d(x: Column, y: Column, angle: float, tx: float, ty: float, cx: float, cy: float) -> list[Column]:
    """A rotation about a centre, then a shift."""
    c, s = math.cos(angle), math.sin(angle)
    return [(x - cx) * c - (y - cy) * s + cx + tx, (x - cx) * s + (y - cy) * c + cy + ty]

