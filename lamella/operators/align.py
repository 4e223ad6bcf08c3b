"""Alignment of surface images on tiles: rigid search over levels, local shifts, dense fields, and the chain of them.

Images are tables of square tiles. A fixed tile meets the moving tiles that its pixels can reach
under any candidate in one row, and the rows of an Arrow batch are worked on together; out of them come
a histogram for each candidate, the differences of each control cell, or warped tiles. Pixels are
rows only where an image enters and where a dense field leaves.

A rigid candidate is an angle number and a whole shift: p goes to R(k * step) (p - c) + c + s and
takes the nearest pixel there. On half the resolution pixel i stands for pixels 2 i and 2 i + 1, so
the centre c becomes (c - 0.5) / 2 and a shift doubles on the way down.

Defined results: pixels without a row are absent and count nowhere; keys without any pixel in
common give no row; equal scores go to the candidate that sorts first; no images give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators.transforms import spline_cells, spline_weights
from lamella.sources.cut import cut

Centre = tuple[float, float]
#: Pixels, and candidates of tiles, that a task works on at once.
CELLS, CANDIDATES = 1 << 20, 1 << 17


def _kinds(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def _portions(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, max(1, rows)):
        yield batch.slice(first, max(1, rows))


def _numbers(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, list[pa.Array]]:
    """The row of each element of an array-of-structs column, and the fields of the elements."""
    return np.repeat(np.arange(len(column)), _numbers(pc.list_value_length(column))), column.flatten().flatten()


def _stack(data: pa.BinaryArray, n: int) -> np.ndarray:
    """Tiles of side n as one array (tile, y, x)."""
    return np.frombuffer(b"".join(data.to_pylist()), "<u2").reshape(-1, n, n)


def _packed(blocks: np.ndarray) -> pa.Array:
    return pa.array([block.tobytes() for block in blocks.astype("<u2", copy=False)], pa.binary())


def tiles(images: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys, channel, ty, tx, size, data) of pixels (keys, channel, y, x, v): 16-bit values plus one, 0 where absent."""
    df = images.select(*keys, "channel", *[F.floor(F.col(a) / size).cast("int").alias(f"t{a}") for a in "yx"], *[F.pmod(F.col(a), F.lit(size)).alias(a) for a in "yx"], "v")
    place = [*keys, "channel", "ty", "tx"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, CELLS // size**2):
                own, pixel = _flat(part.column("pixels"))
                y, x, v = map(_numbers, pixel)
                blocks = np.zeros((part.num_rows, size, size), "<u2")
                blocks[own, y, x] = np.clip(v, 0, 65534) + 1
                yield pa.RecordBatch.from_arrays([*part.select(place).columns, pa.array(np.full(part.num_rows, size, np.int32)), _packed(blocks)], [*place, "size", "data"])

    grouped = df.groupBy(*place).agg(F.collect_list(F.struct("y", "x", "v")).alias("pixels"))
    return grouped.mapInArrow(pack, _kinds(df, [*keys, "channel"]) + "ty int, tx int, size int, data binary")


def pixels(images: DataFrame, keys: list[str]) -> DataFrame:
    """Pixel rows (keys, channel, y, x, v) of tiles."""
    columns = [*keys, "channel"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("size")[0].as_py()
            for part in _portions(batch, CELLS // n**2):
                blocks = _stack(part.column("data"), n)
                t, y, x = np.nonzero(blocks)
                place = [y + _numbers(part.column("ty"))[t] * n, x + _numbers(part.column("tx"))[t] * n, blocks[t, y, x].astype(np.int32) - 1]
                yield pa.RecordBatch.from_arrays([*part.select(columns).take(pa.array(t)).columns, *[pa.array(v.astype(np.int32)) for v in place]], [*columns, "y", "x", "v"])

    return images.select(*columns, "ty", "tx", "size", "data").mapInArrow(run, _kinds(images, columns) + "y int, x int, v int")


def halve_tiles(images: DataFrame, keys: list[str]) -> DataFrame:
    """Tiles of half the resolution: the mean of the present pixels of each 2 x 2, rounded half up."""
    columns = [*keys, "channel"]
    names = [*columns, "ty", "tx", "size", "data"]

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("size")[0].as_py()
            for part in _portions(batch, CELLS // n**2):
                cells = _stack(part.column("data"), n).reshape(-1, n // 2, 2, n // 2, 2)
                present = (cells > 0).sum(axis=(2, 4))
                total = cells.sum(axis=(2, 4), dtype=np.int64) - present
                small = np.where(present > 0, (2 * total + present) // np.maximum(2 * present, 1) + 1, 0)
                yield pa.RecordBatch.from_arrays([*part.select(names[:-1]).columns, _packed(small)], names)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("size")[0].as_py()
            for part in _portions(batch, CELLS // n**2):
                own, (ty, tx, data) = _flat(part.column("parts"))
                blocks = np.zeros((part.num_rows, 2, n // 2, 2, n // 2), "<u2")
                blocks[own, _numbers(ty) % 2, :, _numbers(tx) % 2] = _stack(data, n // 2)
                yield pa.RecordBatch.from_arrays([*part.select(names[:-1]).columns, _packed(blocks.reshape(-1, n, n))], names)

    schema = _kinds(images, columns) + "ty int, tx int, size int, data binary"
    small = images.select(*names).mapInArrow(shrink, schema)
    half = [F.floor(F.col(a) / 2).cast("int").alias(a) for a in ("ty", "tx")]
    fours = small.select(*columns, *half, "size", F.struct("ty", "tx", "data").alias("part"))
    return fours.groupBy(*names[:-1]).agg(F.collect_list("part").alias("parts")).mapInArrow(gather, schema)


def first_of(keys: list[str], *images: DataFrame) -> DataFrame:
    """For each key the images of the first table that has any: a template, else the previous, else the next surface."""
    out = images[0]
    for more in images[1:]:
        out = out.unionByName(more.join(out.select(*keys).distinct(), keys, "left_anti"))
    return out


def _rotated(y: np.ndarray, x: np.ndarray, k: np.ndarray, step: float, centre: Centre) -> tuple[np.ndarray, np.ndarray]:
    """Places (pair, ...) turned by the angle number k of each pair."""
    numbers, at = np.unique(k, return_inverse=True)
    c, s = (np.array([round(f(int(n) * step), 12) for n in numbers])[at].reshape(-1, *[1] * (y.ndim - 1)) for f in (math.cos, math.sin))
    px, py = x - centre[0], y - centre[1]
    return px * s + py * c + centre[1], px * c - py * s + centre[0]


def _nearest(v: np.ndarray) -> np.ndarray:
    return np.floor(np.round(v, 6) + 0.5).astype(int)


class _Meeting:
    """Fixed tiles, their candidates and what they can reach, of a batch of rows.

    ``of`` is the fixed tile of each candidate (k, sx, sy); absent pixels are -1.
    """

    def __init__(self, rows: pa.RecordBatch):
        self.n = n = rows.column("size")[0].as_py()
        self.values = _stack(rows.column("data"), n).astype(int) - 1
        self.ty, self.tx = (_numbers(rows.column(c)).astype(int) for c in ("ty", "tx"))
        self.of, maps = _flat(rows.column("maps"))
        self.k, self.sx, self.sy = (_numbers(m).astype(int) for m in maps)
        t, (my, mx, data) = _flat(rows.column("others"))
        my, mx = _numbers(my).astype(int), _numbers(mx).astype(int)
        # The first moving tile is an absent one; a tile's region is a block of numbers of moving tiles.
        self.moving = np.concatenate((np.zeros((1, n, n), "<u2"), _stack(data, n)))
        starts = np.flatnonzero(np.diff(t, prepend=-1))
        self.oy, self.ox = np.minimum.reduceat(my, starts), np.minimum.reduceat(mx, starts)
        self.gh, self.gw = np.maximum.reduceat(my, starts) + 1 - self.oy, np.maximum.reduceat(mx, starts) + 1 - self.ox
        self.first = np.cumsum(self.gh * self.gw) - self.gh * self.gw
        self.slots = np.zeros(int((self.gh * self.gw).sum()), int)
        self.slots[self.first[t] + (my - self.oy[t]) * self.gw[t] + mx - self.ox[t]] = np.arange(len(t)) + 1

    def portions(self, count: int) -> Iterator[slice]:
        size = max(1, CELLS // self.n**2)
        return (slice(i, min(i + size, count)) for i in range(0, count, size))

    def grid(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pixel places (y, x) of fixed tiles, each (tile, y, x)."""
        own = np.arange(self.n)
        shape = (len(t), self.n, self.n)
        return np.broadcast_to((self.ty[t, None] * self.n + own)[:, :, None], shape), np.broadcast_to((self.tx[t, None] * self.n + own)[:, None, :], shape)

    def turned(self, pairs: slice, step: float, centre: Centre) -> tuple[np.ndarray, np.ndarray]:
        """Nearest moving places of the pixels under candidates."""
        y, x = _rotated(*self.grid(self.of[pairs]), self.k[pairs], step, centre)
        return _nearest(y + self.sy[pairs, None, None]), _nearest(x + self.sx[pairs, None, None])

    def at(self, t: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Moving values at places that the fixed tiles t look at."""
        each = lambda v: v[t][:, None, None]
        ty, tx = y // self.n - each(self.oy), x // self.n - each(self.ox)
        inside = (ty >= 0) & (ty < each(self.gh)) & (tx >= 0) & (tx < each(self.gw))
        slot = np.where(inside, self.slots[np.where(inside, each(self.first) + ty * each(self.gw) + tx, 0)], 0)
        return self.moving[slot, y % self.n, x % self.n].astype(int) - 1


def _meet(fixed: DataFrame, moving: DataFrame, keys: list[str], maps: DataFrame, step: float, centre: Centre, margin: int, run: Callable, columns: str) -> DataFrame:
    """``run(meeting)`` for batches of fixed tiles with what their pixels can reach and their key's maps.

    ``maps`` (keys, maps array of (k, sx, sy)) are the candidates of each key; ``margin`` is
    how much farther than under these a pixel looks. ``run`` gives numbers of fixed tiles and
    Arrow arrays of ``columns``.
    """
    place = [*keys, "channel", "ty", "tx"]
    here = fixed.join(maps, keys).select(*place, "size", "data", "maps")
    ends = ["low_y", "high_y", "low_x", "high_x"]

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            of, found = _flat(batch.column("maps"))
            k, sx, sy = (_numbers(m).astype(int) for m in found)
            n, ty, tx = (_numbers(batch.column(c)).astype(int)[of, None] for c in ("size", "ty", "tx"))
            y, x = _rotated(ty * n + (n - 1) * np.array([0, 0, 1, 1]), tx * n + (n - 1) * np.array([0, 1, 0, 1]), k, step, centre)
            starts, n = np.flatnonzero(np.diff(of, prepend=-1)), _numbers(batch.column("size"))
            low = [np.floor((np.minimum.reduceat(v.min(axis=1) + s, starts) - margin - 1) / n) for v, s in ((y, sy), (x, sx))]
            high = [np.floor((np.maximum.reduceat(v.max(axis=1) + s, starts) + margin + 1) / n) for v, s in ((y, sy), (x, sx))]
            yield pa.RecordBatch.from_arrays([*batch.select(place).columns, *[pa.array(v.astype(np.int32)) for v in (low[0], high[0], low[1], high[1])]], [*place, *ends])

    planned = here.select(*place, "size", "maps").mapInArrow(plan, _kinds(fixed, [*keys, "channel"]) + "ty int, tx int, " + ", ".join(f"{e} int" for e in ends))
    planned = planned.withColumn("my", F.explode(F.sequence("low_y", "high_y"))).withColumn("mx", F.explode(F.sequence("low_x", "high_x"))).drop(*ends)
    near = planned.join(moving.select(*keys, "channel", F.col("ty").alias("my"), F.col("tx").alias("mx"), F.col("data").alias("moving")), [*keys, "channel", "my", "mx"])
    others = near.groupBy(*place).agg(F.collect_list(F.struct("my", "mx", "moving")).alias("others"))
    own = [*keys, "channel"]
    names = [*own, *[c.split()[0] for c in columns.split(", ")]]

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # So many candidates at once that what leaves them stays small.
            counts = np.cumsum(_numbers(pc.list_value_length(batch.column("maps"))))
            first = 0
            while first < batch.num_rows:
                stop = max(first + 1, int(np.searchsorted(counts, (counts[first - 1] if first else 0) + CANDIDATES, "right")))
                part = batch.slice(first, stop - first)
                for t, arrays in run(_Meeting(part)):
                    yield pa.RecordBatch.from_arrays([*part.select(own).take(pa.array(t)).columns, *arrays], names)
                first = stop

    return here.join(others, place).mapInArrow(both, _kinds(fixed, own) + columns)


def _information(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mutual information, summed over the channels, of histograms ``found`` (channel, bins, counts), a list a row; other columns stay."""
    for batch in batches:
        own, (channel, bins, counts) = _flat(batch.column("found"))
        codes = pc.dictionary_encode(channel).indices.to_numpy()
        lengths = _numbers(pc.list_value_length(bins))
        joint = np.repeat(own * (int(codes.max(initial=0)) + 1) + codes, lengths)
        bins = bins.flatten().to_numpy().view(np.uint32).astype(np.int64)
        cells, at = np.unique(joint << 32 | bins, return_inverse=True)
        c = np.bincount(at, _numbers(counts.flatten()), len(cells))
        sums = lambda key: (lambda u: np.bincount(u, c)[u])(np.unique(key, return_inverse=True)[1])
        group = cells >> 32
        n, ca, cb = sums(group), sums(cells >> 16), sums(group << 16 | cells & 0xFFFF)
        row = group // (int(codes.max(initial=0)) + 1)
        mi = np.bincount(row, c / n * np.log(c * n / (ca * cb)), batch.num_rows)
        kept = [f for f in batch.schema.names if f != "found"]
        yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(mi)], [*kept, "mi"])


def rigid_scores(fixed: DataFrame, moving: DataFrame, keys: list[str], maps: DataFrame, step: float, centre: Centre, bin_width: int) -> DataFrame:
    """(keys, k, sx, sy, mi): mutual information of every candidate, summed over the channels.

    A tile sends one row for each candidate, with the filled bins of its histogram; the rows of
    a candidate's tiles are added up in one place.
    """

    def run(m: _Meeting) -> Iterator[tuple[np.ndarray, list]]:
        for pairs in m.portions(len(m.of)):
            t = m.of[pairs]
            values, others = m.values[t], m.at(t, *m.turned(pairs, step, centre))
            both = (values >= 0) & (others >= 0)
            pair = np.nonzero(both)[0]
            cells, counts = np.unique(pair << 32 | values[both] // bin_width << 16 | others[both] // bin_width, return_counts=True)
            met, starts = np.unique(cells >> 32, return_index=True)
            offsets = pa.array(np.append(starts, len(cells)).astype(np.int32))
            bins = (cells & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
            yield t[met], [*[pa.array(v[pairs][met].astype(np.int32)) for v in (m.k, m.sx, m.sy)], pa.ListArray.from_arrays(offsets, pa.array(bins)), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))]

    found = _meet(fixed, moving, keys, maps, step, centre, 0, run, "k int, sx int, sy int, bins array<int>, counts array<int>")
    by = [*keys, "k", "sx", "sy"]
    each = found.groupBy(*by).agg(F.collect_list(F.struct("channel", "bins", "counts")).alias("found"))
    return each.mapInArrow(_information, _kinds(found, by) + "mi double").withColumn("mi", F.round("mi", 9))


def _gathered(candidates: DataFrame, keys: list[str]) -> DataFrame:
    return candidates.groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct(*[F.col(c).cast("int").alias(c) for c in ("k", "sx", "sy")]))).alias("maps"))


def best_candidates(scores: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("mi"), "k", "sx", "sy")
    return scores.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def _turned(x: Column, y: Column, angle: Column, centre: Centre) -> tuple[Column, Column]:
    c, s = F.round(F.cos(angle), 12), F.round(F.sin(angle), 12)
    px, py = x - centre[0], y - centre[1]
    return px * c - py * s + centre[0], px * s + py * c + centre[1]


def points_before(points: DataFrame, found: DataFrame, keys: list[str], step: float, centre: Centre) -> DataFrame:
    """``points`` (keys, px, py) moved by the inverse of their key's rigid map (keys, k, sx, sy); other columns are kept.

    The maps take a template's place to a surface's, so points marked on a surface come back
    to the template. A key without a map keeps its points.
    """
    maps = found.select(*keys, F.col("k").alias("_k"), F.col("sx").alias("_sx"), F.col("sy").alias("_sy"))
    nx, ny = _turned(F.col("px") - F.col("_sx"), F.col("py") - F.col("_sy"), -F.col("_k") * step, centre)
    return points.join(maps, keys, "left").withColumns({"px": F.coalesce(nx, "px"), "py": F.coalesce(ny, "py")}).drop("_k", "_sx", "_sy")


def pulled_scores(scores: DataFrame, anchors: DataFrame, keys: list[str], step: float, centre: Centre, weight: float, scale: int = 1) -> DataFrame:
    """Scores of rigid candidates less ``weight`` times the distances of their maps' points from the anchors.

    ``anchors`` (keys, px, py, qx, qy) pair a fixed with a moving place on the finest grid, a few
    a key; shifts and ``centre`` are pixels of ``scale`` of it. A key without anchors keeps its scores.
    """
    rest = (scale - 1) / 2  # a coarse pixel's centre on the finest grid
    both = scores.join(anchors.select(*keys, "px", "py", "qx", "qy"), keys)
    nx, ny = _turned((F.col("px") - rest) / scale, (F.col("py") - rest) / scale, F.col("k") * step, centre)
    far = F.hypot((nx + F.col("sx")) * scale + rest - F.col("qx"), (ny + F.col("sy")) * scale + rest - F.col("qy"))
    pull = both.groupBy(*keys, "k", "sx", "sy").agg(F.sum(far).alias("_far"))
    return scores.join(pull, [*keys, "k", "sx", "sy"], "left").withColumn("mi", F.round(F.col("mi") - weight * F.coalesce("_far", F.lit(0.0)), 9)).drop("_far")


def rigid_levels(
    fixed: DataFrame,
    moving: DataFrame,
    keys: list[str],
    levels: int,
    step: float,
    turns: int,
    reach: int,
    centre: Centre,
    bin_width: int,
    beam: int = 3,
    anchors: DataFrame | None = None,
    weight: float = 0.0,
) -> DataFrame:
    """(keys, k, sx, sy, mi): best rotation by k * ``step`` and shift of each key, found over ``levels`` of halved tiles.

    The coarsest level looks at all angles up to ``turns`` of its steps (each 2^(levels - 1)
    of the finest) and all shifts up to ``reach`` of its pixels. The best ``beam`` candidates of
    a level expand on the next to the angles half a step around and the shifts one pixel around,
    so (beam x 27) candidates a key and level bound the work whatever the reach. ``anchors``
    pull the scores of every level (see ``pulled_scores``).
    """
    pyramid = [(fixed, moving, centre)]
    for _ in range(levels - 1):
        a, b, c = pyramid[-1]
        pyramid.append((cut(halve_tiles(a, keys)), cut(halve_tiles(b, keys)), tuple((v - 0.5) / 2 for v in c)))
    span = lambda n, by=1: F.explode(F.sequence(F.lit(-n * by), F.lit(n * by), F.lit(by)))
    coarse = 1 << (levels - 1)
    candidates = fixed.select(*keys).distinct().withColumn("k", span(turns, coarse)).withColumn("sx", span(reach)).withColumn("sy", span(reach))
    scores = None
    for level in reversed(range(levels)):
        a, b, c = pyramid[level]
        # A few rows a key, used twice on the next level: without the cut plans double from level to level.
        found = rigid_scores(a, b, keys, _gathered(candidates, keys), step, c, bin_width)
        found = found if anchors is None else pulled_scores(found, anchors, keys, step, c, weight, 1 << level)
        scores = cut(best_candidates(found, keys, beam if level else 1))
        if level:
            half = 1 << (level - 1)
            wider = scores.select(*keys, "k", (2 * F.col("sx")).alias("sx"), (2 * F.col("sy")).alias("sy"))
            for c, by in (("k", half), ("sx", 1), ("sy", 1)):
                wider = wider.withColumn(c, F.explode(F.array(F.col(c) - by, F.col(c), F.col(c) + by)))
            candidates = wider
    return scores


def rigid_field(size: tuple[int, int], found: DataFrame, keys: list[str], step: float, centre: Centre) -> DataFrame:
    """(keys, gy, gx, dx, dy): D(p) = T(p) - p of the rigid maps (keys, k, sx, sy) on a grid of (height, width)."""
    grid = found.select(*keys, "k", "sx", "sy", F.explode(F.sequence(F.lit(0), F.lit(size[0] - 1))).alias("gy")).withColumn("gx", F.explode(F.sequence(F.lit(0), F.lit(size[1] - 1))))
    c, s = F.cos(F.col("k") * step), F.sin(F.col("k") * step)
    px, py = F.col("gx") - centre[0], F.col("gy") - centre[1]
    return grid.select(*keys, "gy", "gx", (px * c - py * s + centre[0] + F.col("sx") - F.col("gx")).alias("dx"), (px * s + py * c + centre[1] + F.col("sy") - F.col("gy")).alias("dy"))


def warp_tiles(grid: DataFrame, moving: DataFrame, keys: list[str], found: DataFrame, step: float, centre: Centre) -> DataFrame:
    """Tiles of the moving image seen on the pixels of ``grid`` tiles through its key's rigid map, nearest pixel."""

    def run(m: _Meeting) -> Iterator[tuple[np.ndarray, list]]:
        for part in m.portions(len(m.of)):  # a key has one map, so a tile has one
            t = m.of[part]
            seen = np.where(m.values[t] >= 0, m.at(t, *m.turned(part, step, centre)), -1)
            some = (seen >= 0).any(axis=(1, 2))
            t = t[some]
            yield t, [*[pa.array(v.astype(np.int32)) for v in (m.ty[t], m.tx[t], np.full(len(t), m.n))], _packed(seen[some] + 1)]

    return _meet(grid, moving, keys, _gathered(found, keys), step, centre, 0, run, "ty int, tx int, size int, data binary")


def local_shifts(fixed: DataFrame, moving: DataFrame, keys: list[str], found: DataFrame, step: float, centre: Centre, cell: int, reach: int) -> DataFrame:
    """(keys, cy, cx, sx, sy): the shift of each control cell, on top of its key's rigid map, with the smallest mean squared difference.

    Differences are averaged over all channels. A cell has to divide the tiles, so it lies in one.
    """

    def run(m: _Meeting) -> Iterator[tuple[np.ndarray, list]]:
        cells = lambda v: v.reshape(len(v), m.n // cell, cell, m.n // cell, cell).sum(axis=(2, 4))
        for part in m.portions(len(m.of)):
            t = m.of[part]
            values, (my, mx) = m.values[t], m.turned(part, step, centre)
            for sy in range(-reach, reach + 1):
                for sx in range(-reach, reach + 1):
                    others = m.at(t, my + sy, mx + sx)
                    both = (values >= 0) & (others >= 0)
                    count, apart = cells(both.astype(np.int64)), cells(np.where(both, (values - others) ** 2, 0))
                    i, cy, cx = np.nonzero(count)
                    whole = [m.ty[t[i]] * (m.n // cell) + cy, m.tx[t[i]] * (m.n // cell) + cx, np.full(len(i), sx), np.full(len(i), sy)]
                    yield t[i], [*[pa.array(v.astype(np.int32)) for v in whole], pa.array(count[i, cy, cx]), pa.array(apart[i, cy, cx])]

    each = _meet(fixed, moving, keys, _gathered(found, keys), step, centre, reach, run, "cy int, cx int, sx int, sy int, n long, apart long")
    total = each.groupBy(*keys, "cy", "cx", "sx", "sy").agg((F.sum("apart") / F.sum("n")).alias("e"))
    best = total.groupBy(*keys, "cy", "cx").agg(F.min(F.struct(F.round("e", 6).alias("e"), F.abs("sx") + F.abs("sy"), "sx", "sy")).alias("m"))
    return best.select(*keys, "cy", "cx", F.col("m.sx").cast("double").alias("sx"), F.col("m.sy").cast("double").alias("sy"))


def cell_penalties(masks: DataFrame, keys: list[str], cell: int, soft: float, stiff: float) -> DataFrame:
    """(keys, cy, cx, weight) of rigidity masks (keys, y, x, m): from ``soft`` where nothing is rigid to ``stiff`` where all is."""
    share = masks.groupBy(*keys, *[F.floor(F.col(a) / cell).cast("int").alias(f"c{a}") for a in "yx"]).agg(F.avg("m").alias("m"))
    return share.select(*keys, "cy", "cx", (soft + (stiff - soft) * F.col("m")).alias("weight"))


def smooth_penalised(cells: DataFrame, penalties: DataFrame, keys: list[str], passes: int) -> DataFrame:
    """Cell shifts drawn to the mean of their four neighbours, pass by pass: s = (1 - w) s0 + w mean(s of the neighbours).

    s0 is the shift found and w the cell's penalty (0 where it has none); a cell without
    neighbours keeps s0. The control grid is small: a cell stands for cell x cell pixels.
    """
    place = [*keys, "cy", "cx"]
    own = cells.join(penalties, place, "left").select(*place, "sx", "sy", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    around = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1))])
    now = own
    for _ in range(passes):
        near = now.select(*place, "sx", "sy", F.explode(around).alias("o")).select(*keys, (F.col("cy") + F.col("o.dy")).alias("cy"), (F.col("cx") + F.col("o.dx")).alias("cx"), "sx", "sy")
        means = near.groupBy(*place).agg(F.avg("sx").alias("mx"), F.avg("sy").alias("my"))
        mixed = [((1 - F.col("weight")) * F.col(s) + F.col("weight") * F.coalesce(m, s)).alias(s) for s, m in (("sx", "mx"), ("sy", "my"))]
        now = own.join(means, place, "left").select(*place, *mixed)
    return now.select(*place, "sx", "sy")


def dense_field(cells: DataFrame, keys: list[str], cell: int, size: tuple[int, int]) -> DataFrame:
    """(keys, gy, gx, dx, dy): control cells (keys, cy, cx, sx, sy) as a cubic B-spline on every pixel of (height, width).

    The cell's shift stands at its middle. Cells at the border are repeated outward. Each piece
    between control cells is one row with its 4 x 4 shifts and is spread to its pixels in place.
    """
    height, width = size
    nodes = cells
    for a, extent in (("y", height), ("x", width)):
        last = -(-extent // cell) - 1
        at = F.col(f"c{a}")
        first = F.when(at == 0, F.array(F.lit(-1), F.lit(-2))).otherwise(F.array().cast("array<int>"))
        beyond = F.when(at == last, F.array(F.lit(last + 1), F.lit(last + 2))).otherwise(F.array().cast("array<int>"))
        nodes = nodes.withColumn(f"c{a}", F.explode(F.concat(F.array(at), first, beyond)))
    # Nodes are counted from the outermost, two before the first cell.
    nodes = nodes.select(*keys, (F.col("cy") + 2).alias("iy"), (F.col("cx") + 2).alias("ix"), F.col("sx").alias("dx"), F.col("sy").alias("dy"))
    support = spline_cells(nodes, keys, [-(-extent // cell) + 4 for extent in (width, height)]).withColumns({c: F.col(c) - 2 for c in ("_cy", "_cx")})
    df = support
    for a, extent in (("y", height), ("x", width)):
        start = F.ceil((F.col(f"_c{a}") + 1.5) * cell - 0.5)
        low, high = F.greatest(start, F.lit(0)), F.least(F.ceil((F.col(f"_c{a}") + 2.5) * cell - 0.5) - 1, F.lit(extent - 1))
        df = df.withColumn(f"g{a}", F.explode(F.when(low <= high, F.sequence(low, high))))
        df = df.withColumn(f"_w{a}", F.array(*spline_weights((F.col(f"g{a}") + 0.5) / cell - 0.5 - F.col(f"_c{a}") - 1)))
    df = df.where("gy is not null and gx is not null")
    shift = lambda c: sum((F.col("_wy")[j] * F.col("_wx")[i] * F.col("_nodes")[4 * j + i][c] for j in range(4) for i in range(4)), F.lit(0.0))
    return df.select(*keys, F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx"), shift("dx").alias("dx"), shift("dy").alias("dy"))


def align_surfaces(
    previous: DataFrame,
    following: DataFrame,
    template: DataFrame,
    keys: list[str],
    size: tuple[int, int],
    *,
    levels: int,
    step: float,
    turns: int,
    reach: int,
    bin_width: int,
    cell: int,
    local_reach: int,
    penalties: DataFrame | None = None,
    passes: int = 4,
    beam: int = 3,
    nonrigid: bool = True,
) -> DataFrame:
    """(keys, side, gy, gx, dx, dy): fields from the template's grid to the previous and to the following surface.

    Tables of tiles in, outsides filled. The previous surface goes to the template by a rigid
    map (the following one where there is no previous); without a template the previous, else the
    following surface takes its place. Where both are there, the previous surface as seen on the
    template's grid is aligned with the following one: rigid, then local shifts, smoothed by their
    penalties and spread as a B-spline. Without ``nonrigid`` both sides get the previous field.
    A key with one surface gets that side's field only.
    """
    centre = ((size[1] - 1) / 2, (size[0] - 1) / 2)
    search = {"levels": levels, "step": step, "turns": turns, "reach": reach, "centre": centre, "bin_width": bin_width, "beam": beam}
    grid = first_of(keys, template, previous, following)
    first = first_of(keys, previous, following)
    found = rigid_levels(grid, first, keys, **search)
    field = rigid_field(size, found, keys, step, centre)
    has = lambda side: side.select(*keys).distinct()
    before = field.join(has(previous), keys, "left_semi").withColumn("side", F.lit("previous"))
    alone = field.join(has(previous), keys, "left_anti").withColumn("side", F.lit("following"))
    pairs = has(previous).join(has(following), keys, "left_semi")
    if nonrigid:
        seen = cut(warp_tiles(grid.join(pairs, keys, "left_semi"), previous, keys, found, step, centre))
        second = rigid_levels(seen, following, keys, **search)
        cells = cut(local_shifts(seen, following, keys, second, step, centre, cell, local_reach))
        if penalties is not None:
            cells = smooth_penalised(cells, penalties, keys, passes)
        start = rigid_field(size, second, keys, step, centre)
        bent = dense_field(cells, keys, cell, size).select(*keys, "gy", "gx", F.col("dx").alias("bx"), F.col("dy").alias("by"))
        after = start.join(bent, [*keys, "gy", "gx"], "left").select(*keys, "gy", "gx", *[(F.col(f"d{a}") + F.coalesce(f"b{a}", F.lit(0.0))).alias(f"d{a}") for a in "xy"])
    else:
        after = field.join(pairs, keys, "left_semi")
    columns = [*keys, "side", "gy", "gx", "dx", "dy"]
    return before.select(*columns).union(alone.select(*columns)).union(after.withColumn("side", F.lit("following")).select(*columns))
