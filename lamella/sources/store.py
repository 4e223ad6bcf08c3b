"""Chunk store, planes, frames and brains.

A chunk is one row: its place, its shape and little-endian unsigned 16-bit pixels. Chunks
of zeros are not stored; a missing chunk or frame reads as zeros.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _keyed(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def from_voxels(voxels: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys, cz, cy, cx, data) cubic chunks of voxels (keys, z, y, x, v); a chunk is one group of bounded size."""
    df = voxels.where("v > 0").select(*keys, *[F.floor(F.col(a) / size).cast("int").alias(f"c{a}") for a in "zyx"], *[(F.col(a) % size).alias(a) for a in "zyx"], "v")
    place = [*keys, "cz", "cy", "cx"]

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = np.zeros((size, size, size), "<u2")
        block[rows["z"], rows["y"], rows["x"]] = np.clip(rows["v"], 0, 65535)
        return pd.DataFrame([[*key, size, block.tobytes()]], columns=[*place, "size", "data"])

    return df.groupBy(*place).applyInPandas(pack, f"{_keyed(df, place)}, size int, data binary")


def _blocks(chunks: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    for i, (n, data) in enumerate(zip(chunks["size"], chunks["data"], strict=True)):
        yield i, np.frombuffer(data, "<u2").reshape(n, n, n)


def to_voxels(chunks: DataFrame) -> DataFrame:
    """Long form of chunks, without zeros."""
    keys = [c for c in chunks.columns if c not in ("cz", "cy", "cx", "size", "data")]

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, block in _blocks(batch):
                row = batch.iloc[i]
                z, y, x = np.nonzero(block)
                n = row["size"]
                yield pd.DataFrame({**{k: row[k] for k in keys}, "z": z + row["cz"] * n, "y": y + row["cy"] * n, "x": x + row["cx"] * n, "v": block[z, y, x].astype(int)})

    return chunks.mapInPandas(unpack, f"{_keyed(chunks, keys)}, z int, y int, x int, v int")


def chunk_sums(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Filled voxels and their sum for each chunk."""
    place = [*keys, "cz", "cy", "cx"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blocks = [b for _, b in _blocks(batch)]
            yield batch[place].assign(filled=[int((b > 0).sum()) for b in blocks], total=[int(b.sum(dtype=np.int64)) for b in blocks])

    return chunks.mapInPandas(run, f"{_keyed(chunks, place)}, filled long, total long")


def max_projection_chunks(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Maximum along z: each chunk is flattened where it lies, then the flat pieces are merged."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, block in _blocks(batch):
                row, flat = batch.iloc[i], block.max(axis=0)
                y, x = np.nonzero(flat)
                yield pd.DataFrame({**{k: row[k] for k in keys}, "y": y + row["cy"] * row["size"], "x": x + row["cx"] * row["size"], "v": flat[y, x].astype(int)})

    return chunks.mapInPandas(run, f"{_keyed(chunks, keys)}, y int, x int, v int").groupBy(*keys, "y", "x").agg(F.max("v").alias("v"))


def planes(chunks: DataFrame, keys: list[str], quantized: bool = False) -> DataFrame:
    """(keys, z, y0, height, width, data): planes in strips as high as a chunk, quantised on request.

    Each chunk is cut into slabs where it lies, and the slabs of a strip are put side by side
    in one group, so a group holds one strip whatever the size of a plane. Strips of zeros are
    not stored; a missing strip reads as zeros.
    """
    place = [*keys, "z", "cy", "cx"]

    def slabs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for i, block in _blocks(batch):
                row = batch.iloc[i]
                n = row["size"]
                if quantized:
                    block = np.minimum((block.astype(np.int64) + 8 >> 4) << 4, 65520).astype("<u2")
                found += [[*row[keys], row["cz"] * n + k, row["cy"], row["cx"], n, slab.tobytes()] for k, slab in enumerate(block) if slab.any()]
            yield pd.DataFrame(found, columns=[*place, "size", "data"])

    def strip(rows: pd.DataFrame) -> pd.DataFrame:
        n, first = int(rows["size"].iloc[0]), rows.iloc[0]
        out = np.zeros((n, (int(rows["cx"].max()) + 1) * n), "<u2")
        for cx, data in zip(rows["cx"], rows["data"], strict=True):
            out[:, cx * n : cx * n + n] = np.frombuffer(data, "<u2").reshape(n, n)
        return pd.DataFrame([[*first[keys], first["z"], first["cy"] * n, *out.shape, out.tobytes()]], columns=[*keys, "z", "y0", "height", "width", "data"])

    kinds = f"{_keyed(chunks, keys)}, z int, "
    cut = chunks.mapInPandas(slabs, kinds + "cy int, cx int, size int, data binary")
    return cut.groupBy(*keys, "z", "cy").applyInPandas(strip, kinds + "y0 int, height int, width int, data binary")


def write_planes(chunks: DataFrame, path: str, keys: list[str], quantized: bool = False) -> None:
    """Planes of chunks as Parquet, a folder for each volume, so that one volume or plane is read alone."""
    planes(chunks, keys, quantized).write.mode("overwrite").partitionBy(*keys).parquet(path)


def read_planes(spark: SparkSession, path: str, schema: str | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Strips of written planes, of planes ``first`` to ``last`` on request; ``schema`` fixes the kinds of the keys."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    df = df if first is None else df.where(F.col("z") >= first)
    return df if last is None else df.where(F.col("z") <= last)


def planes_to_voxels(strips: DataFrame, keys: list[str]) -> DataFrame:
    """Long form of strips, without zeros."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                strip = np.frombuffer(row["data"], "<u2").reshape(row["height"], row["width"])
                y, x = np.nonzero(strip)
                yield pd.DataFrame({**{k: row[k] for k in keys}, "z": row["z"], "y": y + row["y0"], "x": x, "v": strip[y, x].astype(int)})

    return strips.mapInPandas(unpack, f"{_keyed(strips, keys)}, z int, y int, x int, v int")


def read_frames(frames: DataFrame, keys: list[str], start: int, stop: int | None = None) -> DataFrame:
    """Frames [start, stop) of each key (one frame without a stop); absent ones are marked ``missing``."""
    stop = start + 1 if stop is None else stop
    wanted = frames.select(*keys).distinct().withColumn("frame", F.explode(F.sequence(F.lit(start), F.lit(stop - 1))))
    inside = frames.where((F.col("frame") >= start) & (F.col("frame") < stop)).withColumn("_here", F.lit(True))
    return wanted.join(inside, [*keys, "frame"], "left").withColumn("missing", F.col("_here").isNull()).drop("_here")


def read_frame_pixels(frames: DataFrame, keys: list[str], start: int, stop: int | None, height: int, width: int, full_width: int | None = None) -> DataFrame:
    """(keys, frame, height, width, spacing, data): frames [start, stop) as little-endian 16-bit pixels.

    ``frames`` (keys, frame, data) hold pixels of ``height`` by ``width``; an absent frame is
    zeros of that size. Thumbnails give ``full_width``, the width of what they show, and get
    the ratio of the widths as their spacing; else it is 1.
    """
    zeros = F.unhex(F.repeat(F.lit("0000"), height * width))
    got = read_frames(frames.select(*keys, "frame", "data"), keys, start, stop)
    spacing = full_width / width if full_width else 1.0
    return got.select(*keys, "frame", F.lit(height).alias("height"), F.lit(width).alias("width"), F.lit(float(spacing)).alias("spacing"), F.coalesce("data", zeros).alias("data"))


def write_brain(slices: DataFrame, field: DataFrame, path: str, sphere_map: DataFrame | None = None) -> None:
    """Slice boxes, displacement fields and the sphere map; the field is split by slice, so one slice is read alone."""
    slices.write.mode("overwrite").parquet(f"{path}/slices")
    field.write.mode("overwrite").partitionBy("slice_id").parquet(f"{path}/field")
    if sphere_map is not None:
        sphere_map.write.mode("overwrite").parquet(f"{path}/sphere_map")


def read_brain(spark: SparkSession, path: str, slice_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(slices, field) of a written brain, of one slice on request."""
    slices, field = spark.read.parquet(f"{path}/slices"), spark.read.parquet(f"{path}/field")
    if slice_id is None:
        return slices, field
    return slices.where(F.col("slice_id") == slice_id), field.where(F.col("slice_id") == slice_id)


def read_sphere_map(spark: SparkSession, path: str) -> DataFrame:
    """The sphere map of a written brain."""
    return spark.read.parquet(f"{path}/sphere_map")
