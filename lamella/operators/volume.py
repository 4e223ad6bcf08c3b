"""Voxel jobs: block plans, resampling, blending, projection, and plane naming.

Long form is (keys, z, y, x, v) with absent voxels being 0. Production volumes are
chunked; the chunk helpers in ``lamella.functions.kernels`` and ``lamella.sources.store``
work on those with the same rules. A sample position in [-0.5, n - 0.5) is inside and
clamps, others give 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = "xyz"


def plan_blocks(boxes: DataFrame, pixel: float, block_x: int | None = None, block_z: int | None = None, roi: dict[str, Column | float] | None = None, column: int | None = None) -> DataFrame:
    """Tiles of output blocks for each column of a slice, in grid pixels from the lower corner of a region.

    ``roi`` gives lo_x to hi_z in the slice, the slice's box by default; its upper end is moved
    up to the grid. A column's y range is its box on the grid, cut to the region; columns outside
    go. The first column of a slice begins and the last ends with the region. Cut points are the
    previous column's end and the next column's start where they fall inside. With ``column``
    that one alone is planned, and fills the region. Blocks step x and z, by default as many
    pixels as fit 8 x depth / 1.6, 512 at most, and 1024; each gives up to three tiles; empty
    ones go.
    """
    whole = Window.partitionBy("slice_id", "channel_id")
    by = whole.orderBy("column_id")
    box = {f"lo_{a}": F.min(f"lo_{a}").over(whole) for a in AXES} | {f"hi_{a}": F.max(f"hi_{a}").over(whole) for a in AXES}
    region = box if roi is None else {k: F.lit(v) for k, v in roi.items()}
    on_grid = lambda v: F.round((v - F.col("r_y")) / pixel, 6)
    depth = F.floor(F.round((box["hi_z"] - box["lo_z"]) / 1.6 / pixel, 6)) * 8
    df = boxes.select(
        "slice_id", "channel_id", "column_id", "lo_y", "hi_y",
        region["lo_y"].alias("r_y"),
        *[F.ceil(F.round((region[f"hi_{a}"] - region[f"lo_{a}"]) / pixel, 6)).cast("int").alias(f"n{a}") for a in AXES],
        F.lag("hi_y").over(by).alias("before"), F.lead("lo_y").over(by).alias("after"),
        (F.least(depth, F.lit(512)).cast("int") if block_x is None else F.lit(block_x)).alias("step_x"), F.lit(1024 if block_z is None else block_z).alias("step_z"),
    )
    if column is not None:
        df = df.where(F.col("column_id") == column).withColumns({c: F.lit(None).cast("double") for c in ("before", "after")})
    top = F.col("r_y") + F.col("ny") * pixel
    low, high = F.greatest("lo_y", "r_y"), F.least(F.col("hi_y"), top)
    df = df.withColumns({"b": F.ceil(on_grid(low)).cast("int"), "e": F.floor(on_grid(high)).cast("int"), "prev": F.floor(on_grid(F.col("before"))).cast("int"), "next": F.ceil(on_grid(F.col("after"))).cast("int")}).where(high > low)
    df = df.withColumn("y0", F.when(F.col("before").isNull(), 0).otherwise(F.col("b"))).withColumn("y3", F.when(F.col("after").isNull(), F.col("ny")).otherwise(F.col("e")))
    cut = lambda c, other: F.when((F.col(c) > F.col("y0")) & (F.col(c) < F.col("y3")), F.col(c)).otherwise(other)
    df = df.withColumn("y1", cut("prev", F.col("y0"))).withColumn("y2", cut("next", F.col("y3")))
    steps = lambda a: F.sequence(F.lit(0), F.greatest(F.col(f"n{a}") - 1, F.lit(0)), F.greatest(F.col(f"step_{a}"), F.lit(1)))
    df = df.withColumn("x0", F.explode(steps("x"))).withColumn("z0", F.explode(steps("z")))
    tiles = F.array(*[F.struct(F.col(a).alias("t0"), F.col(b).alias("t1")) for a, b in (("y0", "y1"), ("y1", "y2"), ("y2", "y3"))])
    df = df.select("*", F.posexplode(tiles).alias("tile", "t")).where("t.t1 > t.t0 and nx > 0 and nz > 0")
    ends = lambda a: F.least(F.col(f"{a}0") + F.greatest(F.col(f"step_{a}"), F.lit(1)), F.col(f"n{a}")).alias(f"{a}1")
    return df.select("slice_id", "channel_id", "column_id", "tile", "x0", ends("x"), F.col("t.t0").alias("ty0"), F.col("t.t1").alias("ty1"), "z0", ends("z"))


def block_source_range(blocks: DataFrame) -> DataFrame:
    """Frames [f0, f1) that a block (lo_*, hi_*, params, n_frames) needs; null where it misses its column.

    The block's corners go through the column's map; the needed box is min - 1 to max + 2.
    """
    p = F.col("params")
    corners = [sum((p[6 + k] * F.col(f"{e}_{a}") for k, (e, a) in enumerate(zip(c, AXES, strict=True))), p[11]) for c in [(i, j, k) for i in ("lo", "hi") for j in ("lo", "hi") for k in ("lo", "hi")]]
    lo, hi = F.round(F.least(*corners) - 1, 6), F.round(F.greatest(*corners) + 2, 6)
    n = F.col("n_frames")
    hit = (hi >= 0) & (lo <= n)
    clip = lambda v: F.least(F.greatest(v, F.lit(0)), n).cast("int")
    return blocks.withColumn("f0", F.when(hit, clip(F.floor(lo)))).withColumn("f1", F.when(hit, clip(F.ceil(hi))))


def _sample(df: DataFrame, at: dict[str, Column], sizes: dict[str, int]) -> DataFrame:
    """Trilinear corners of each row: integer positions ``s_z, s_y, s_x`` and weight ``w``; outside rows go."""
    for a in AXES:
        df = df.withColumn(f"_{a}", at[a])
    for a in AXES:
        df = df.where((F.col(f"_{a}") >= -0.5) & (F.col(f"_{a}") < sizes[a] - 0.5))
    for a in AXES:
        c = F.least(F.greatest(F.col(f"_{a}"), F.lit(0.0)), F.lit(sizes[a] - 1.0))
        f = c - F.floor(c)
        both = F.array(F.struct(F.floor(c).cast("int").alias("i"), (1 - f).alias("w")), F.struct((F.floor(c) + 1).cast("int").alias("i"), f.alias("w")))
        df = df.withColumn(f"_k{a}", F.explode(F.filter(both, lambda k: k["w"] > 0)))
    keep = [c for c in df.columns if not c.startswith("_")]
    return df.select(*keep, *[F.col(f"_k{a}.i").alias(f"s_{a}") for a in AXES], (F.col("_kx.w") * F.col("_ky.w") * F.col("_kz.w")).alias("w"))


def resample_affine(grid: DataFrame, voxels: DataFrame, keys: list[str], params: list[float], sizes: dict[str, int]) -> DataFrame:
    """Source values at M p + t for output voxels (keys, z, y, x), rounded half up to 16 bits; outside 0.

    Twin of the chunk kernel: eight weighted corners joined on the source voxel.
    """
    p = [F.col(a) for a in AXES]
    at = {a: sum((F.lit(float(params[3 * r + c])) * p[c] for c in range(3)), F.lit(float(params[9 + r]))) for r, a in enumerate(AXES)}
    corners = _sample(grid, at, sizes)
    source = voxels.select(*keys, *[F.col(a).alias(f"s_{a}") for a in AXES], "v")
    sums = corners.join(source, [*keys, "s_x", "s_y", "s_z"]).groupBy(*keys, *AXES).agg(F.sum(F.col("w") * F.col("v")).alias("v"))
    value = F.least(F.greatest(F.floor(F.round(F.coalesce("v", F.lit(0.0)), 6) + 0.5), F.lit(0)), F.lit(65535)).cast("int")
    return grid.join(sums, [*keys, *AXES], "left").withColumn("v", value)


def blend_tiles(tiles: DataFrame, keys: list[str], mode: str = "middle") -> DataFrame:
    """One value where columns overlap, from rows (keys, column_id, ly, n, v); ly is the place in n tile lines."""
    first, last = F.min_by("v", "column_id"), F.max_by("v", "column_id")
    rules = {
        "right_side": last.cast("double"),
        "left_side": first.cast("double"),
        "average": (first + last) * 0.5,
        "middle": F.when(F.min_by("ly", "column_id") < F.floor(F.min_by("n", "column_id") / 2), first).otherwise(last).cast("double"),
    }
    return tiles.groupBy(*keys).agg(rules[mode].alias("v"))


def assemble_volume(tiles: DataFrame, sizes: dict[str, int], keys: list[str]) -> DataFrame:
    """Dense grid of each volume with gaps 0, for volumes small enough to be dense."""
    grid = tiles.select(*keys).distinct()
    for a in AXES:
        grid = grid.withColumn(a, F.explode(F.sequence(F.lit(0), F.lit(sizes[a] - 1))))
    return grid.join(tiles, [*keys, *AXES], "left").withColumn("v", F.coalesce("v", F.lit(0)))


def max_projection(voxels: DataFrame, keys: list[str], axis: str = "z") -> DataFrame:
    """Largest value along an axis; map-side combining leaves one row a ray and task for the shuffle."""
    return voxels.groupBy(*keys, *[a for a in ("z", "y", "x") if a != axis]).agg(F.max("v").alias("v"))


def downsample(voxels: DataFrame, keys: list[str], sizes: dict[str, int], factor: dict[str, float]) -> DataFrame:
    """Linear samples at k * factor for k up to ceil(n / factor); zeros left out.

    A source voxel gives its weight to the outputs within one voxel of it, so no grid is made.
    Past the last voxel, by less than half of one, a sample takes the last value.
    """
    df = voxels
    for a in AXES:
        n = -(-sizes[a] // factor[a])
        f = F.lit(float(factor[a]))
        near = F.sequence(F.greatest(F.ceil((F.col(a) - 1) / f), F.lit(0)), F.least(F.floor((F.col(a) + 1) / f), F.lit(int(n) - 1)))
        near = F.when(F.ceil((F.col(a) - 1) / f) <= F.least(F.floor((F.col(a) + 1) / f), F.lit(int(n) - 1)), near)
        df = df.withColumn(f"o_{a}", F.explode(near)).withColumn(f"w_{a}", 1 - F.abs(F.least(F.col(f"o_{a}") * f, F.lit(sizes[a] - 1.0)) - F.col(a))).where(f"w_{a} > 0").where(F.col(f"o_{a}") * f < sizes[a] - 0.5)
    return df.groupBy(*keys, *[F.col(f"o_{a}").cast("int").alias(a) for a in ("z", "y", "x")]).agg(F.sum(F.col("w_x") * F.col("w_y") * F.col("w_z") * F.col("v")).alias("v"))


def shear_volume(frames: DataFrame, shift: float) -> DataFrame:
    """Deskewed stack: line y of frame z moves by z * shift, to the nearest line."""
    return frames.withColumn("y", F.bround(F.col("y") + F.col("z") * shift, 0).cast("int"))


def warp_slice(grid: DataFrame, voxels: DataFrame, moved: DataFrame, keys: list[str], sizes: dict[str, int], pixel: float) -> DataFrame:
    """Slice values at the moved positions (point_id, qx, qy, qz in micrometres) of output points; outside 0."""
    df = grid.join(moved, "point_id")
    corners = _sample(df, {a: F.col(f"q{a}") / pixel for a in AXES}, sizes).select("point_id", *keys, "s_x", "s_y", "s_z", "w")
    source = voxels.select(*keys, *[F.col(a).alias(f"s_{a}") for a in AXES], "v")
    sums = corners.join(source, [*keys, "s_x", "s_y", "s_z"]).groupBy("point_id", *keys).agg(F.sum(F.col("w") * F.col("v")).alias("v"))
    return grid.join(sums, ["point_id", *keys], "left").withColumn("v", F.coalesce("v", F.lit(0.0)))


def brain_planes(planes: DataFrame, thickness: float, pixel: float, channel: str, folders: bool = True) -> DataFrame:
    """Global plane number, file name and spacing in mm of planes (slice_id, k)."""
    number = (F.col("slice_id") - 1) * int(thickness / pixel) + F.col("k")
    name = F.format_string(f"Z%05d_C{channel}", number)
    name = F.concat(F.col("slice_id").cast("string"), F.lit("/"), name) if folders else name
    return planes.withColumn("plane", number.cast("int")).withColumn("name", name).withColumn("spacing_mm", F.lit(pixel / 1000))


def slab_projection(voxels: DataFrame, thickness: int) -> DataFrame:
    """Maxima over runs of ``thickness`` planes of a slice, each run named by its first plane.

    Plane numbers are ranked on the distinct planes, a small table, not on the voxels.
    """
    planes = voxels.select("slice_id", "channel_id", "z").distinct()
    rank = F.row_number().over(Window.partitionBy("slice_id", "channel_id").orderBy("z")) - 1
    slab = planes.withColumn("slab", F.floor(rank / thickness).cast("int"))
    first = slab.withColumn("first_z", F.min("z").over(Window.partitionBy("slice_id", "channel_id", "slab")))
    return voxels.join(first, ["slice_id", "channel_id", "z"]).groupBy("slice_id", "channel_id", "slab", "first_z", "y", "x").agg(F.max("v").alias("v"))


def mosaic(tiles: DataFrame, block: int, width: int, height: int, n_start: int, n_end: int) -> DataFrame:
    """Pixels of tiles (kx, ky, z, ly, lx, v) at their place in a plane, cut to its size and a plane range."""
    df = tiles.where((F.col("z") >= n_start) & (F.col("z") < n_end))
    df = df.select("z", (F.col("ky") * block + F.col("ly")).alias("y"), (F.col("kx") * block + F.col("lx")).alias("x"), "v").where((F.col("x") < width) & (F.col("y") < height))
    return df.groupBy("z", "y", "x").agg(F.max("v").alias("v"))


def energy_blend(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """Fold in column order from 1 by (v^2 + a^2) / (a + v), less 1."""
    ordered = F.sort_array(F.collect_list(F.struct("column_id", F.col("v").cast("double").alias("v"))))
    return tiles.groupBy(*keys).agg((F.aggregate(ordered, F.lit(1.0), lambda a, t: (t["v"] * t["v"] + a * a) / (a + t["v"])) - 1).alias("v"))
