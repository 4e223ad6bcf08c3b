"""Resampling and warping on the chunk store.

An output block is planned with the range of source chunks that it needs, joined with those
by their place, and sampled in one group. So a source chunk is shuffled once for each output
block that it reaches, not once a voxel, and a group holds the chunks of one block's source
box whatever the size of the volume. The long forms in ``lamella.operators.volume`` give the
same values.

``downsample_chunks`` is such a resampling on a straight grid. ``fill_blank_chunks`` carries
values along z from chunk to chunk: a chunk sends two flat pieces, not itself, to the group
that works out what reaches each chunk from below and from above.

Defined results: chunks that are absent read as zeros; a block without a source chunk, or
with zeros only, gives no row; no chunks give no rows; output voxels outside the wanted
sizes are 0; positions outside the source give 0; where a field has no value, voxels stay;
a region without a voxel along an axis gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions.kernels import bilinear, trilinear
from lamella.operators.surface import BLANK

AXES = "zyx"
#: Widening of planned source ranges, so that rounding never leaves a needed voxel out.
_SLACK = 1e-6


def _targets(chunks: DataFrame, keys: list[str], size: int, sizes: dict[str, int]) -> DataFrame:
    """(keys, bz, by, bx, first voxel l_a and last voxel h_a by axis) of the output blocks of each volume."""
    df = chunks.select(*keys).distinct()
    for a in AXES:
        df = df.withColumn(f"b{a}", F.explode(F.sequence(F.lit(0), F.lit(-(-sizes[a] // size) - 1)) if sizes[a] > 0 else F.array().cast("array<int>")))
    ends = {f"l_{a}": F.col(f"b{a}") * size for a in AXES} | {f"h_{a}": F.least(F.col(f"b{a}") * size + size, F.lit(sizes[a])) - 1 for a in AXES}
    return df.withColumns(ends)


def _with_sources(blocks: DataFrame, chunks: DataFrame, keys: list[str], ranges: dict[str, tuple[Column, Column]], size: int, source: dict[str, int]) -> DataFrame:
    """Each block once for each stored chunk that its source positions, from lowest to highest by axis, touch."""
    df = blocks
    for a in AXES:
        lo, hi = ranges[a][0] - _SLACK, ranges[a][1] + _SLACK
        first = F.greatest(F.floor(lo), F.lit(0))
        last = F.least(F.floor(hi) + 1, F.lit(source[a] - 1))
        df = df.where((hi >= -0.5) & (lo < source[a] - 0.5))
        df = df.withColumn(f"c{a}", F.explode(F.sequence(F.floor(F.least(first, F.lit(source[a] - 1)) / size).cast("int"), F.floor(F.greatest(last, F.lit(0)) / size).cast("int"))))
    return df.join(chunks.select(*keys, "cz", "cy", "cx", "data"), [*keys, "cz", "cy", "cx"])


def _sampled(at: list[np.ndarray], rows: pd.DataFrame, size: int, source: dict[str, int]) -> np.ndarray:
    """16-bit values at source positions (z, y, x), rounded half up, from the chunks of a group."""
    inside = np.ones(at[0].shape, bool)
    for p, a in zip(at, AXES, strict=True):
        inside &= (p >= -0.5) & (p < source[a] - 0.5)
    out = np.zeros(at[0].shape, "<u2")
    if not inside.any():
        return out
    near = [np.clip(p[inside], 0, source[a] - 1) for p, a in zip(at, AXES, strict=True)]
    low = [int(p.min()) for p in near]
    block = np.zeros([int(p.max()) + 2 - o for p, o in zip(near, low, strict=True)])
    for cz, cy, cx, data in zip(rows["cz"], rows["cy"], rows["cx"], rows["data"], strict=True):
        chunk = np.frombuffer(data, "<u2").reshape(size, size, size)
        start = [c * size - o for c, o in zip((cz, cy, cx), low, strict=True)]
        into = tuple(slice(max(s, 0), max(s + size, 0)) for s in start)
        part = block[into]
        off = [max(-s, 0) for s in start]
        block[into] = chunk[tuple(slice(o, o + n) for o, n in zip(off, part.shape, strict=True))]
    v = trilinear(block, *[p - o for p, o in zip(near, low, strict=True)])
    out[inside] = np.clip(np.floor(np.round(v, 6) + 0.5), 0, 65535)
    return out


def _grid(first: pd.Series, sizes: dict[str, int], size: int) -> list[np.ndarray]:
    """Voxel numbers (z, y, x) of a block, cut to the wanted sizes."""
    return [g.astype(float) for g in np.meshgrid(*[np.arange(first[f"b{a}"] * size, min((first[f"b{a}"] + 1) * size, sizes[a])) for a in AXES], indexing="ij")]


def _row(first: pd.Series, keys: list[str], values: np.ndarray, size: int) -> pd.DataFrame:
    columns = [*keys, "cz", "cy", "cx", "size", "data"]
    if not values.any():
        return pd.DataFrame(columns=columns)
    block = np.zeros((size, size, size), "<u2")
    block[tuple(slice(0, n) for n in values.shape)] = values
    return pd.DataFrame([[*first[keys], *[first[f"b{a}"] for a in AXES], size, block.tobytes()]], columns=columns)


def _schema(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", cz int, cy int, cx int, size int, data binary"


def resample_chunks(chunks: DataFrame, keys: list[str], params: list[float], source: dict[str, int], sizes: dict[str, int], size: int) -> DataFrame:
    """Chunks of the volumes of ``sizes`` whose voxel (x, y, z) is the source at M p + t.

    ``params`` are the nine values of M by row and the three of t, in the order x, y, z;
    ``chunks`` (keys, cz, cy, cx, size, data) are cubes of edge ``size`` of volumes of
    ``source`` voxels.
    """
    blocks = _targets(chunks, keys, size, sizes)
    ranges = {}
    for r, a in enumerate("xyz"):
        rows = [(float(params[3 * r + c]), b) for c, b in enumerate("xyz")]
        low = sum((F.col(f"{'l' if p >= 0 else 'h'}_{b}") * p for p, b in rows), F.lit(float(params[9 + r])))
        high = sum((F.col(f"{'h' if p >= 0 else 'l'}_{b}") * p for p, b in rows), F.lit(float(params[9 + r])))
        ranges[a] = (low, high)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        z, y, x = _grid(first, sizes, size)
        at = {a: params[3 * r] * x + params[3 * r + 1] * y + params[3 * r + 2] * z + params[9 + r] for r, a in enumerate("xyz")}
        return _row(first, keys, _sampled([at[a] for a in AXES], rows, size, source), size)

    joined = _with_sources(blocks, chunks, keys, ranges, size, source).select(*keys, "bz", "by", "bx", "cz", "cy", "cx", "data")
    return joined.groupBy(*keys, "bz", "by", "bx").applyInPandas(run, _schema(chunks, keys))


def downsample_chunks(chunks: DataFrame, keys: list[str], source: dict[str, int], factor: dict[str, float], size: int) -> DataFrame:
    """Chunks of the linear samples at k * factor for k up to ceil(n / factor), rounded half up."""
    sizes = {a: int(-(-source[a] // factor[a])) for a in AXES}
    params = [float(factor[a]) if a == b else 0.0 for a in "xyz" for b in "xyz"] + [0.0] * 3
    return resample_chunks(chunks, keys, params, source, sizes, size)


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first and the last value above ``BLANK`` along z of each chunk, as flat pieces; 0 where there is none."""
    for batch in batches:
        found = []
        for n, data in zip(batch["size"], batch["data"], strict=True):
            block = np.frombuffer(data, "<u2").reshape(n, n, n)
            seen = block > BLANK
            some = seen.any(axis=0)
            first = np.take_along_axis(block, seen.argmax(axis=0)[None], 0)[0]
            last = np.take_along_axis(block, (n - 1 - seen[::-1].argmax(axis=0))[None], 0)[0]
            found.append([np.where(some, piece, 0).astype("<u2").tobytes() for piece in (first, last)])
        yield batch.drop(columns="data").assign(first=[f for f, _ in found], last=[e for _, e in found])


def fill_blank_chunks(chunks: DataFrame, keys: list[str], n_z: int, size: int) -> DataFrame:
    """Along z a value up to 90 takes the last above 90 before it, leading ones the next, else 0.

    ``chunks`` (keys, cz, cy, cx, size, data) are cubes of edge ``size`` of volumes ``n_z``
    voxels high. The flat pieces of a pencil of chunks meet in one group; it holds 2 / ``size``
    of the pencil's voxels, and gives each place of the pencil what comes before and after it.
    """
    kinds = ", ".join(f"`{k}` {chunks.schema[k].dataType.simpleString()}" for k in keys)
    pencil = [*keys, "cy", "cx"]
    pieces = chunks.select(*keys, "cz", "cy", "cx", "size", "data").mapInPandas(_ends, kinds + ", cz int, cy int, cx int, size int, first binary, last binary")

    def carry(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        places = -(-n_z // size)
        flat = {n: dict(zip(rows["cz"], rows[n], strict=True)) for n in ("first", "last")}

        def reached(name: str, order: range) -> dict[int, bytes]:
            now, at = np.zeros(size * size, "<u2"), {}
            for cz in order:
                at[cz] = now.tobytes()
                if cz in flat[name]:
                    piece = np.frombuffer(flat[name][cz], "<u2")
                    now = np.where(piece > 0, piece, now)
            return at

        before, after = reached("last", range(places)), reached("first", range(places - 1, -1, -1))
        return pd.DataFrame([[*key[:-2], cz, *key[-2:], before[cz], after[cz]] for cz in range(places)], columns=[*keys, "cz", "cy", "cx", "before", "after"])

    carried = pieces.groupBy(*pencil).applyInPandas(carry, kinds + ", cz int, cy int, cx int, before binary, after binary")
    joined = carried.join(chunks.select(*keys, "cz", "cy", "cx", "data"), [*keys, "cz", "cy", "cx"], "left")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for cz, before, after, data in zip(batch["cz"], batch["before"], batch["after"], batch["data"], strict=True):
                block = np.zeros((size, size, size), "<u2") if data is None else np.frombuffer(data, "<u2").reshape(size, size, size).copy()
                now = np.frombuffer(before, "<u2").reshape(size, size)
                for k in range(size):
                    now = np.where(block[k] > BLANK, block[k], now)
                    block[k] = now
                later = np.frombuffer(after, "<u2").reshape(size, size)
                for k in range(size - 1, -1, -1):  # only leading places are still empty
                    later = np.where(block[k] > 0, block[k], later)
                    block[k] = later
                block[max(n_z - cz * size, 0) :] = 0
                out.append(block.tobytes() if block.any() else None)
            filled = batch.drop(columns=["before", "after"]).assign(size=size, data=out)
            yield filled[filled["data"].notna()][[*keys, "cz", "cy", "cx", "size", "data"]]

    return joined.mapInPandas(fill, _schema(chunks, keys))


def region_sizes(roi: dict[str, tuple[float, float]], spacing: dict[str, float]) -> dict[str, int]:
    """Whole voxels of ``spacing`` in a region (lowest and highest place by axis)."""
    return {a: int((roi[a][1] - roi[a][0]) / spacing[a]) for a in AXES}


def warp_chunks(
    chunks: DataFrame,
    keys: list[str],
    field: DataFrame,
    source: dict[str, int],
    sizes: dict[str, int],
    size: int,
    spacing: dict[str, float],
    source_pixel: float,
    pixel: float,
    width: int,
    height: int,
    thickness: float,
    roi: dict[str, tuple[float, float]] | None = None,
    source_origin: dict[str, float] | None = None,
) -> DataFrame:
    """Chunks of slices whose voxel p, at p * ``spacing`` below the slice's corner, is the source moved by the field.

    ``keys`` hold slice_id. ``field`` (slice_id, plane, gy, gx, dx, dy, dz) is on a grid of
    ``pixel``, plane 0 at the top of a slice and plane 1 at its bottom. A block meets the
    field's cells under it only, and their extremes bound the source chunks that it needs.
    With ``roi``, lowest and highest places by axis below the slice's corner, voxel 0 is at
    its lowest place and ``sizes`` are its whole voxels. ``source_origin`` is the place of the
    source's voxel 0 below the slice's corner, the corner itself if not given.
    """
    base = {a: roi[a][0] if roi else 0.0 for a in AXES}
    origin = source_origin or dict.fromkeys(AXES, 0.0)
    sizes = region_sizes(roi, spacing) if roi else sizes
    place_of = lambda c, a: F.col(c) * spacing[a] + base[a]
    blocks = _targets(chunks, keys, size, sizes)
    place = [*keys, "bz", "by", "bx"]
    ends = [f"{e}_{a}" for e in "lh" for a in AXES]
    cells = blocks
    for a, n in (("y", height), ("x", width)):
        clamp = lambda c, top=n - 1, a=a: F.least(F.greatest(F.floor(place_of(c, a) / pixel).cast("int"), F.lit(0)), F.lit(top))
        cells = cells.withColumn(f"g{a}", F.explode(F.sequence(clamp(f"l_{a}"), F.least(clamp(f"h_{a}") + 1, F.lit(n - 1)))))
    values = [F.coalesce(f"d{a}", F.lit(0.0)) for a in "xyz"]
    one = F.array(F.col("plane").cast("double"), F.col("gy").cast("double"), F.col("gx").cast("double"), *values)
    cells = cells.join(field.select("slice_id", "plane", "gy", "gx", "dx", "dy", "dz"), ["slice_id", "gy", "gx"], "left")
    extremes = [f(g(v, F.lit(0.0))).alias(f"{n}_{a}") for n, f, g in (("least", F.min, F.least), ("most", F.max, F.greatest)) for a, v in zip("xyz", values, strict=True)]
    blocks = cells.groupBy(*place, *ends).agg(F.collect_list(F.when(F.col("plane").isNotNull(), one)).alias("cells"), *extremes)
    ranges = {a: ((place_of(f"l_{a}", a) + F.col(f"least_{a}") - origin[a]) / source_pixel, (place_of(f"h_{a}", a) + F.col(f"most_{a}") - origin[a]) / source_pixel) for a in AXES}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        grid = _grid(first, sizes, size)
        p = {a: g * spacing[a] + base[a] for g, a in zip(grid, AXES, strict=True)}
        if len(first["cells"]):
            c = np.stack(list(first["cells"]))
            plane, gy, gx = c[:, 0].astype(int), c[:, 1].astype(int), c[:, 2].astype(int)
            y0, x0 = gy.min(), gx.min()
            d = np.zeros((3, 2, gy.max() - y0 + 1, gx.max() - x0 + 1))
            d[:, plane, gy - y0, gx - x0] = c[:, 3:].T
            u, v, t = p["x"] / pixel, p["y"] / pixel, p["z"] / thickness
            inside = (u >= -0.5) & (u < width - 0.5) & (v >= -0.5) & (v < height - 0.5) & (t >= -0.5) & (t < 1.5)
            u, v, t = np.clip(u, 0, width - 1) - x0, np.clip(v, 0, height - 1) - y0, np.clip(t, 0, 1)
            for k, a in enumerate("xyz"):
                p[a] = p[a] + inside * (bilinear(d[k, 0], v, u) * (1 - t) + bilinear(d[k, 1], v, u) * t)
        return _row(first, keys, _sampled([(p[a] - origin[a]) / source_pixel for a in AXES], rows, size, source), size)

    joined = _with_sources(blocks, chunks, keys, ranges, size, source).select(*place, "cells", "cz", "cy", "cx", "data")
    return joined.groupBy(*place).applyInPandas(run, _schema(chunks, keys))
