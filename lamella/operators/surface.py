"""Tissue surfaces: blank filling, edges, height maps, extraction, masks and templates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.pixels import log_intensity
from lamella.sources.cut import cut

#: The edge kernel along z (its last tap is positive), and the difference kernel.
EDGE = (0.5, 1.0, 2.0, 4.0, 8.0, 0.0, -8.0, -4.0, -2.0, -1.0, 0.5)
DIFFERENCE = (1.0, 0.0, -1.0)
BLANK = 90


def fill_blank(voxels: DataFrame, keys: list[str]) -> DataFrame:
    """Along z a value up to 90 takes the last above 90 before it, leading ones the next, else 0."""
    ray = Window.partitionBy(*keys, "y", "x").orderBy("z")
    seen = F.when(F.col("v") > BLANK, F.col("v"))
    before = F.last(seen, ignorenulls=True).over(ray.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(seen, ignorenulls=True).over(ray.rowsBetween(0, Window.unboundedFollowing))
    return voxels.withColumn("v", F.coalesce(before, after, F.lit(0)))


def _convolve(values: str, kernel: tuple[float, ...]) -> F.Column:
    """True convolution of an array column, ends replicated; the kernel is flipped."""
    half, n = len(kernel) // 2, F.size(values)
    arr = F.col(values)
    padded = F.concat(F.array_repeat(F.element_at(arr, 1), half), arr, F.array_repeat(F.element_at(arr, -1), half))
    taps = F.array(*[F.lit(k) for k in reversed(kernel)])
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.aggregate(F.zip_with(F.slice(padded, i, F.lit(len(kernel))), taps, lambda v, k: v * k), F.lit(0.0), lambda a, b: a + b))


def edge_gradients(rays: DataFrame, upper: bool) -> DataFrame:
    """``edge`` of rays (keys, v: array along z): kernel, clamp to one sign, difference, sign."""
    df = rays.withColumn("_e", _convolve("v", EDGE))
    df = df.withColumn("_c", F.transform("_e", lambda e: F.greatest(e, F.lit(0.0)) if upper else F.least(e, F.lit(0.0))))
    return df.withColumn("_d", _convolve("_c", DIFFERENCE)).withColumn("edge", F.transform("_d", lambda d: d * (1.0 if upper else -1.0))).drop("_e", "_c", "_d")


def rays(voxels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, y, x, v): one array along z for each (y, x), of voxels that are dense in z."""
    return voxels.groupBy(*keys, "y", "x").agg(F.transform(F.sort_array(F.collect_list(F.struct("z", "v"))), lambda s: s["v"].cast("double")).alias("v"))


def extract_surface(voxels: DataFrame, heights: DataFrame, n_z: int) -> DataFrame:
    """(slice_id, side, y, x, v): voxels sampled linearly in z at u + 1 and at l, as bytes; outside 0."""
    sides = F.array(F.struct(F.lit("u").alias("side"), (F.col("u") + 1).alias("d")), F.struct(F.lit("l").alias("side"), F.col("l").alias("d")))
    at = heights.select("slice_id", "y", "x", F.explode(sides).alias("s")).select("slice_id", "y", "x", "s.side", "s.d")
    inside = (F.col("d") >= -0.5) & (F.col("d") < n_z - 0.5)
    c = F.least(F.greatest(F.col("d"), F.lit(0.0)), F.lit(n_z - 1.0))
    ends = F.array(F.struct(F.floor(c).cast("int").alias("z"), (1 - (c - F.floor(c))).alias("w")), F.struct((F.floor(c) + 1).cast("int").alias("z"), (c - F.floor(c)).alias("w")))
    points = at.where(inside).withColumn("e", F.explode(ends)).select("slice_id", "side", "y", "x", "e.z", "e.w").where("w > 0")
    sums = points.join(voxels.select("slice_id", "z", "y", "x", "v"), ["slice_id", "z", "y", "x"]).groupBy("slice_id", "side", "y", "x").agg(F.sum(F.col("w") * F.col("v")).alias("v"))
    out = at.join(sums, ["slice_id", "side", "y", "x"], "left")
    return out.select("slice_id", "side", "y", "x", log_intensity(F.round(F.coalesce("v", F.lit(0.0)), 6), True).alias("v"))


#: Pixels along the side of a tile of the fill.
TILE = 256


def _labels(dark: np.ndarray) -> np.ndarray:
    """4-connected regions of a mask: each pixel gets the smallest number in its region, from 1; others 0."""
    own = np.where(dark, np.arange(1, dark.size + 1).reshape(dark.shape), 0)
    while True:
        before = own
        # Runs along rows, then along columns, take their smallest number at once.
        for axis in (1, 0):
            own = _runs(own, axis)
        if (own == before).all():
            return own


def _runs(own: np.ndarray, axis: int) -> np.ndarray:
    flat = own if axis == 1 else own.T
    padded = np.concatenate((flat, np.zeros((flat.shape[0], 1), flat.dtype)), axis=1).ravel()
    starts = np.flatnonzero((padded > 0) & (np.concatenate(([0], padded[:-1])) == 0))
    if not len(starts):
        return own
    ends = np.flatnonzero((padded == 0) & (np.concatenate(([0], padded[:-1])) > 0))
    least = np.minimum.reduceat(padded, np.stack((starts, ends), 1).ravel())[::2]
    out = padded.copy()
    out[padded > 0] = np.repeat(least, ends - starts)
    out = out.reshape(flat.shape[0], -1)[:, :-1]
    return out if axis == 1 else out.T


def fill_outside(images: DataFrame, keys: list[str], value: int, tile: int = TILE) -> DataFrame:
    """Pixels up to ``value`` that 4-connect to a corner become ``value``; corners count as 0.

    The regions of each tile are labelled where it lies, and those that touch across a tile's
    border are linked. From the corners' regions on, linked regions are reached round by round;
    a round joins the labels reached last, a few rows for each tile. So an image of any size is
    filled tile by tile, and only labels travel between tiles. Pixels without a row are not dark.
    """
    kinds = "".join(f"`{k}` {images.schema[k].dataType.simpleString()}, " for k in keys)
    place = [*keys, "ty", "tx"]
    extent = images.groupBy(*keys).agg(F.max("y").alias("ey"), F.max("x").alias("ex"))
    rows = images.select(*keys, "y", "x", "v").join(extent, keys)
    ends = [(F.col(a) == 0) | (F.col(a) == F.col(f"e{a}")) for a in "yx"]
    at_corner = ends[0] & ends[1]
    rows = rows.select(*keys, "y", "x", F.when(at_corner, 0).otherwise(F.col("v")).alias("v"), at_corner.alias("corner"), *[F.floor(F.col(a) / tile).cast("int").alias(f"t{a}") for a in "yx"])

    def label(part: pa.Table) -> pa.Table:
        """Whole tiles with their labels; they stand below each other in one array, with a row between."""
        y, x, ty, tx = (part.column(c).to_numpy().astype(np.int64) for c in ("y", "x", "ty", "tx"))
        starts = tile_starts(part)
        sizes = np.diff(np.append(starts, len(y)))
        y, x = y - ty * tile, x - tx * tile
        heights = np.maximum.reduceat(y, starts) + 2
        y += np.repeat(np.cumsum(heights) - heights, sizes)
        mask = np.zeros((heights.sum(), x.max() + 1), bool)
        mask[y, x] = pc.fill_null(pc.less_equal(part.column("v"), value), False).to_numpy()
        return part.append_column("label", pa.array(_labels(mask)[y, x].astype(np.int32)))

    def tile_starts(part: pa.Table) -> np.ndarray:
        codes = [part.column(c).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for c in place]
        return np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in codes], axis=0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last tile of a batch may go on in the next
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            part = (part if held is None else pa.concat_tables([held, part])).combine_chunks()
            last = int(tile_starts(part)[-1])
            if last:
                yield from label(part.slice(0, last)).combine_chunks().to_batches()
            held = part.slice(last)
        if held is not None:
            yield from label(held).combine_chunks().to_batches()

    rows = rows.withColumns({c: F.col(c).cast("int") for c in ("y", "x", "v")})
    labelled = cut(rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, kinds + "y int, x int, v int, corner boolean, ty int, tx int, label int"))
    dark = labelled.where("label > 0")
    node = [*keys, "ty", "tx", "label"]
    # A region meets those of the next tile to the right and below, pixel against pixel.
    links = None
    for a, other in (("x", "y"), ("y", "x")):
        edge = dark.where(F.col(a) % tile == tile - 1).select(*node, (F.col(a) + 1).alias(a), other)
        beside = dark.where(F.col(a) % tile == 0).select(*keys, a, other, *[F.col(c).alias(f"{c}_2") for c in node[-3:]])
        pairs = edge.join(beside, [*keys, a, other]).select(*node, *[f"{c}_2" for c in node[-3:]]).distinct()
        links = pairs if links is None else links.union(pairs)
    back = links.select(*keys, *[F.col(f"{c}_2").alias(c) for c in node[-3:]], *[F.col(c).alias(f"{c}_2") for c in node[-3:]])
    links = cut(links.union(back))
    last = cut(dark.where("corner").select(*node).distinct())
    reached = last
    while last.head(1):
        near = links.join(last, node).select(*keys, *[F.col(f"{c}_2").alias(c) for c in node[-3:]]).distinct()
        last = cut(near.join(reached, node, "left_anti"))
        reached = cut(reached.union(last))
    out = labelled.join(reached.withColumn("_out", F.lit(True)), node, "left")
    return out.select(*keys, "y", "x", F.when(F.col("_out"), F.lit(value)).otherwise(F.col("v")).alias("v"))


def rigidity_mask(images: DataFrame, keys: list[str], outside: int) -> DataFrame:
    """1 where v >= outside + 1, opened: eroded, then dilated by one pixel; nothing lies past the border."""
    around = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])

    def step(df: DataFrame, agg) -> DataFrame:
        near = df.withColumn("o", F.explode(around)).select(*keys, (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), "m")
        return near.groupBy(*keys, "y", "x").agg(agg("m").alias("m")).join(df.select(*keys, "y", "x"), [*keys, "y", "x"], "left_semi")

    return step(step(images.select(*keys, "y", "x", (F.col("v") >= outside + 1).cast("int").alias("m")), F.min), F.max)


def place_template(template: DataFrame, keys: list[str], size: tuple[int, int], scale: float, ref: tuple[int, int]) -> DataFrame:
    """Template pixels (keys, y, x, v) scaled and centred in a reference frame, linear on its pixel grid; zeros left out."""
    df = template
    for a, n, m in zip("yx", size, ref, strict=True):
        origin = (m - n * scale) / 2
        lo, hi = F.ceil((F.col(a) - 1) * scale + origin), F.floor((F.col(a) + 1) * scale + origin)
        lo, hi = F.greatest(lo, F.lit(0)), F.least(hi, F.lit(m - 1))
        df = df.withColumn(f"o_{a}", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
        at = (F.col(f"o_{a}") - origin) / scale
        clamped = F.least(F.greatest(at, F.lit(0.0)), F.lit(n - 1.0))
        df = df.withColumn(f"w_{a}", F.when((at >= -0.5) & (at < n - 0.5), 1 - F.abs(clamped - F.col(a))).otherwise(0.0)).where(f"w_{a} > 0")
    return df.groupBy(*keys, F.col("o_y").cast("int").alias("y"), F.col("o_x").cast("int").alias("x")).agg(F.sum(F.col("w_y") * F.col("w_x") * F.col("v")).alias("v"))
