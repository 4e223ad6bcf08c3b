"""Scores of shifts between volumes on the chunk store, and a search over them from coarse to fine.

A moving chunk is cut into the pieces that reach a fixed chunk under any shift, so a fixed
chunk meets its own surroundings once (one moving chunk and slabs of its neighbours as thick as
the shifts reach), whatever the number of shifts. All shifts are scored there in one group;
what leaves it are six sums, or the filled bins of one histogram, for each shift, and these are
added up in every task before they are shuffled. Voxels are never rows.

Zeros are absent voxels here as everywhere in the store: a position counts where both volumes
have a value. The long forms in ``lamella.operators.register`` give the same results.

Defined results: keys without any chunk in common, or whose overlap is too small under every
shift, give no row; equal scores go to the shift that sorts first; no chunks give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.operators.register import best_by_information, best_by_ncc, mutual_information
from lamella.sources.store import chunk_sums

AXES = "zyx"
#: Shifts from lowest to highest on the axes x, y, z.
Ranges = list[tuple[int, int]]
Value = Callable[[np.ndarray], np.ndarray]


def _kinds(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def halo_pieces(moving: DataFrame, keys: list[str], ranges: Ranges) -> DataFrame:
    """(keys, tz, ty, tx, oz, oy, ox, lz, ly, lx, data): what each fixed chunk t can meet of the moving chunks.

    ``moving`` (keys, cz, cy, cx, size, data, bz, by, bx) stands shifted by its base b, so that
    a fixed voxel p meets moving voxels p + b + s for the shifts s of ``ranges``; o and l are
    a piece's place and size in the surroundings of t, which begin at the lowest shifts.
    """
    reach = dict(zip("xyz", ranges, strict=True))
    columns = [*keys, *[f"{k}{a}" for k in "tol" for a in AXES], "data"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.to_dict("records"):
                n = row["size"]
                block = np.frombuffer(row["data"], "<u2").reshape(n, n, n)
                start = {a: row[f"c{a}"] * n - row[f"b{a}"] for a in AXES}
                along = {}
                for a in AXES:
                    low, high = reach[a]
                    first, last = -((-start[a] + n - 1 + high) // n), (start[a] + n - 1 - low) // n
                    along[a] = [(t, max(start[a], t * n + low), min(start[a] + n, t * n + n + high), t * n + low) for t in range(first, last + 1)]
                for at in product(*[along[a] for a in AXES]):
                    piece = block[tuple(slice(p[1] - start[a], p[2] - start[a]) for a, p in zip(AXES, at, strict=True))]
                    if piece.any():
                        found.append([*[row[k] for k in keys], *[p[0] for p in at], *[p[1] - p[3] for p in at], *piece.shape, piece.tobytes()])
            yield pd.DataFrame(found, columns=columns)

    schema = _kinds(moving, keys) + ", ".join(f"{k}{a} int" for k in "tol" for a in AXES) + ", data binary"
    return moving.mapInPandas(cut, schema)


def _scored(fixed: DataFrame, moving: DataFrame, keys: list[str], ranges: Ranges, base: DataFrame | None, value: Value | None, score: Callable, columns: str) -> DataFrame:
    """Rows of ``score(a, b)`` for each fixed chunk and shift, with a and b the values where both are present."""
    places = [f"b{a}" for a in "xyz"]
    based = moving.join(base.select(*keys, *places), keys, "left").fillna(0, places) if base is not None else moving.withColumns({b: F.lit(0) for b in places})
    pieces = halo_pieces(based, keys, ranges)
    own = fixed.select(*keys, *[F.col(f"c{a}").alias(f"t{a}") for a in AXES], "size", "data")
    by = [*keys, *[f"t{a}" for a in AXES]]
    names = [*keys, "sx", "sy", "sz", *[c.split()[0] for c in columns.split(", ")]]

    def run(here: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if here.empty or near.empty:
            return pd.DataFrame(columns=names)
        n, key = int(here["size"].iloc[0]), [here[k].iloc[0] for k in keys]
        a = np.frombuffer(here["data"].iloc[0], "<u2").reshape(n, n, n)
        around = np.zeros([n + hi - lo for lo, hi in reversed(ranges)], "<u2")
        for p in near.to_dict("records"):
            shape = [p[f"l{x}"] for x in AXES]
            around[tuple(slice(p[f"o{x}"], p[f"o{x}"] + m) for x, m in zip(AXES, shape, strict=True))] = np.frombuffer(p["data"], "<u2").reshape(shape)
        present = a > 0
        values, others = (a, around) if value is None else (value(a), value(around))
        rows = []
        for sz, sy, sx in product(*[range(lo, hi + 1) for lo, hi in reversed(ranges)]):
            at = tuple(slice(s - lo, s - lo + n) for s, (lo, _) in zip((sz, sy, sx), reversed(ranges), strict=True))
            both = present & (around[at] > 0)
            if both.any():
                rows += [[*key, sx, sy, sz, *found] for found in score(values[both].astype(float), others[at][both].astype(float))]
        return pd.DataFrame(rows, columns=names)

    schema = _kinds(fixed, keys) + "sx int, sy int, sz int, " + columns
    out = own.groupBy(*by).cogroup(pieces.groupBy(*by)).applyInPandas(run, schema)
    if base is None:
        return out
    # The shift is told from the fixed to the moving volume, base included.
    out = out.join(base.select(*keys, *places), keys, "left").fillna(0, places)
    return out.select(*keys, *[(F.col(f"s{a}") + F.col(f"b{a}")).cast("int").alias(f"s{a}") for a in "xyz"], *names[len(keys) + 3 :])


def translation_ncc_chunks(fixed: DataFrame, moving: DataFrame, keys: list[str], ranges: Ranges, n_fixed: int | None = None, base: DataFrame | None = None, value: Value | None = None) -> DataFrame:
    """(keys, sx, sy, sz, ncc, n): best shift by normalised cross-correlation, among ``base`` (keys, bx, by, bz) + ``ranges``.

    At least a tenth of the fixed voxels have to overlap: of ``n_fixed``, or else of those
    that the key has.
    """

    def score(a: np.ndarray, b: np.ndarray) -> list[list[float]]:
        return [[len(a), a.sum(), b.sum(), (a * a).sum(), (b * b).sum(), (a * b).sum()]]

    columns = ["n", "sa", "sb", "saa", "sbb", "sab"]
    parts = _scored(fixed, moving, keys, ranges, base, value, score, "n long, " + ", ".join(f"{c} double" for c in columns[1:]))
    sums = parts.groupBy(*keys, "sx", "sy", "sz").agg(*[F.sum(c).alias(c) for c in columns])
    if n_fixed is not None:
        return best_by_ncc(sums, keys, F.lit(n_fixed))
    filled = chunk_sums(fixed, keys).groupBy(*keys).agg(F.sum("filled").alias("n_fixed"))
    return best_by_ncc(sums.join(filled, keys), keys, F.col("n_fixed"))


def align_channel_chunks(fixed: DataFrame, moving: DataFrame, keys: list[str], ranges: Ranges, bin_width: int, base: DataFrame | None = None) -> DataFrame:
    """(keys, sx, sy, sz, mi): shift with the largest mutual information of binned values."""

    def score(a: np.ndarray, b: np.ndarray) -> list[list[int]]:
        pairs, counts = np.unique(((a // bin_width).astype(int) << 16) + (b // bin_width).astype(int), return_counts=True)
        return [[p >> 16, p & 0xFFFF, c] for p, c in zip(pairs.tolist(), counts.tolist(), strict=True)]

    bins = _scored(fixed, moving, keys, ranges, base, None, score, "a int, b int, c long")
    joint = bins.groupBy(*keys, "sx", "sy", "sz", "a", "b").agg(F.sum("c").alias("c"))
    return best_by_information(mutual_information(joint, [*keys, "sx", "sy", "sz"]), keys, ["sx", "sy", "sz"])


def halve(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks of half the resolution: the mean of the present voxels of each 2 x 2 x 2, rounded half up.

    Each chunk shrinks where it lies and becomes an eighth of a new one.
    """
    place = ["cz", "cy", "cx"]
    kinds = _kinds(chunks, keys)

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            small = []
            for n, data in zip(batch["size"], batch["data"], strict=True):
                cells = np.frombuffer(data, "<u2").reshape(n // 2, 2, n // 2, 2, n // 2, 2)
                total, present = cells.sum(axis=(1, 3, 5), dtype=np.int64), (cells > 0).sum(axis=(1, 3, 5))
                small.append(((2 * total + present) // np.maximum(2 * present, 1)).astype("<u2").tobytes())
            yield batch[[*keys, *place, "size"]].assign(data=small)

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        n, first = int(rows["size"].iloc[0]), rows.iloc[0]
        block = np.zeros((n, n, n), "<u2")
        for at, data in zip(rows[place].to_numpy(), rows["data"], strict=True):
            block[tuple(slice(c % 2 * n // 2, c % 2 * n // 2 + n // 2) for c in at)] = np.frombuffer(data, "<u2").reshape(n // 2, n // 2, n // 2)
        return pd.DataFrame([[*first[keys], *[first[c] // 2 for c in place], n, block.tobytes()]], columns=[*keys, *place, "size", "data"])

    schema = f"{kinds}cz int, cy int, cx int, size int, data binary"
    small = chunks.select(*keys, *place, "size", "data").mapInPandas(shrink, schema)
    parents = [F.floor(F.col(c) / 2).alias(f"_{c}") for c in place]
    return small.groupBy(*keys, *parents).applyInPandas(gather, schema)


def coarse_to_fine(fixed: DataFrame, moving: DataFrame, keys: list[str], levels: int, reach: int, refine: int = 1, value: Value | None = None) -> DataFrame:
    """(keys, sx, sy, sz, ncc, n): best shift found on halved volumes within ``reach`` and refined level by level.

    The best shift of a level is doubled and is the base of the next, which looks ``refine``
    around it; a key without a score on a level starts the next one at no shift. The reach is
    ``reach`` x 2^(levels - 1) voxels and more, at (2 reach + 1)^3 shifts on the smallest
    volumes and (2 refine + 1)^3 on all others.
    """
    pyramid = [(fixed, moving)]
    for _ in range(levels - 1):
        pyramid.append((halve(pyramid[-1][0], keys), halve(pyramid[-1][1], keys)))
    best, around = None, [(-reach, reach)] * 3
    for a, b in reversed(pyramid):
        base = None if best is None else best.select(*keys, *[(2 * F.col(f"s{x}")).cast("int").alias(f"b{x}") for x in "xyz"])
        best = translation_ncc_chunks(a, b, keys, around, base=base, value=value)
        around = [(-refine, refine)] * 3
    return best
