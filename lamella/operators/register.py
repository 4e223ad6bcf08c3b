"""Registration as scoring jobs: candidates, scores by aggregation, arg-max.

The optimisers of the field are stochastic; here each search is a deterministic list of
candidates with the same metric and acceptance rules. Ties go to the candidate that
sorts first. Score sums are partial per task, so a shuffle carries one row a candidate
(or a histogram bin) and task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators.geometry import affine
from lamella.operators.select import BACKGROUND_SHARE, BACKGROUND_THRESHOLDS


def column_overlap(columns: DataFrame) -> DataFrame:
    """For each column after the first: overlap start in the one before, end in it, frame offset, sub-step offset.

    The columns carry ``params``, ``pixel_size``, their slice box ``lo_*``/``hi_*`` and the
    number of image lines.
    """
    by = Window.partitionBy("slice_id", "channel_id").orderBy("column_id")
    df = columns.select("*", *[F.lag(c).over(by).alias(f"p_{c}") for c in ("params", "lo_x", "lo_y", "lo_z", "hi_y")]).where("p_params is not null")
    here = affine(F.col("params"), F.col("lo_x"), F.col("p_hi_y"), F.col("lo_z"))
    before = affine(F.col("p_params"), F.col("lo_x"), F.col("lo_y"), F.col("lo_z"))
    x1, x2 = before[0], here[0]
    step = F.col("spacing")
    return df.select("slice_id", "channel_id", "column_id", x1.alias("x1"), x2.alias("x2"), F.bround(here[2] - before[2], 0).cast("int").alias("z_offset"), (x1 - (x1 / step).cast("int") * step).alias("offset"))


def candidate_windows(frames: DataFrame, n_frames: int, z_offset: int = 0) -> DataFrame:
    """First usable frame of each column pair (slice_id, column_id, frame, v): threshold by threshold, then by frame.

    Frames c = 100 + min(z, 0), step 100, to n - 100 - min(-z, 0); both columns' frames c and
    c - z must not be background. A window reaches 100 frames to both sides.
    """
    c = F.explode(F.sequence(F.lit(100 + min(z_offset, 0)), F.lit(n_frames - 100 - min(-z_offset, 0)), F.lit(100)))
    shares = [F.avg(F.when((F.col("v") >= 0) & (F.col("v") <= t), 1.0).otherwise(0.0)).alias(f"s{k}") for k, t in enumerate(BACKGROUND_THRESHOLDS)]
    per = frames.groupBy("slice_id", "column_id", "frame").agg(*shares)
    pairs = frames.select("slice_id", "column_id").distinct().where("column_id > 0").withColumn("c", c)
    left = per.select("slice_id", (F.col("column_id") + 1).alias("column_id"), F.col("frame").alias("c"), *[F.col(f"s{k}").alias(f"a{k}") for k in range(len(shares))])
    right = per.select("slice_id", "column_id", (F.col("frame") + z_offset).alias("c"), *[F.col(f"s{k}").alias(f"b{k}") for k in range(len(shares))])
    both = pairs.join(left, ["slice_id", "column_id", "c"]).join(right, ["slice_id", "column_id", "c"])
    rank = F.coalesce(*[F.when((F.col(f"a{k}") <= BACKGROUND_SHARE) & (F.col(f"b{k}") <= BACKGROUND_SHARE), k) for k in range(len(shares))])
    best = both.withColumn("rank", rank).where("rank is not null").groupBy("slice_id", "column_id").agg(F.min(F.struct("rank", "c")).alias("m"))
    return best.select("slice_id", "column_id", F.element_at(F.array(*map(F.lit, BACKGROUND_THRESHOLDS)), F.col("m.rank") + 1).alias("threshold"), F.col("m.c").alias("frame"), (F.col("m.c") - 100).alias("start"), (F.col("m.c") + 100).alias("stop"))


def _shifts(xs: tuple[int, int], ys: tuple[int, int], zs: tuple[int, int]) -> F.Column:
    """All shifts (sx, sy, sz) of three closed ranges, as literals."""
    return F.array(*[F.struct(F.lit(x).alias("sx"), F.lit(y).alias("sy"), F.lit(z).alias("sz")) for x in range(xs[0], xs[1] + 1) for y in range(ys[0], ys[1] + 1) for z in range(zs[0], zs[1] + 1)])


def translation_ncc(fixed: DataFrame, moving: DataFrame, keys: list[str], ranges: list[tuple[int, int]], n_fixed: int) -> DataFrame:
    """Best integer shift (sx, sy, sz) by normalised cross-correlation of values at p and p + shift.

    Valid only where at least a tenth of the ``n_fixed`` voxels overlap. Each fixed voxel
    meets the shifted moving ones by an equi-join; six sums a shift give the score.
    """
    a = fixed.select(*keys, "z", "y", "x", F.col("v").cast("double").alias("a")).withColumn("s", F.explode(_shifts(*ranges))).select("*", "s.*").drop("s")
    at = a.select(*keys, "sx", "sy", "sz", (F.col("z") + F.col("sz")).alias("z"), (F.col("y") + F.col("sy")).alias("y"), (F.col("x") + F.col("sx")).alias("x"), "a")
    both = at.join(moving.select(*keys, "z", "y", "x", F.col("v").cast("double").alias("b")), [*keys, "z", "y", "x"])
    sums = both.groupBy(*keys, "sx", "sy", "sz").agg(F.count(F.lit(1)).alias("n"), *[F.sum(e).alias(n) for n, e in {"sa": F.col("a"), "sb": F.col("b"), "saa": F.col("a") * F.col("a"), "sbb": F.col("b") * F.col("b"), "sab": F.col("a") * F.col("b")}.items()])
    return best_by_ncc(sums, keys, F.lit(n_fixed))


def best_by_ncc(sums: DataFrame, keys: list[str], n_fixed: F.Column) -> DataFrame:
    """(keys, sx, sy, sz, ncc, n) of the best shift by six sums; at least a tenth of ``n_fixed`` voxels have to overlap."""
    spread = F.sqrt((F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")) * (F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")))
    ncc = F.try_divide(F.col("sab") - F.col("sa") * F.col("sb") / F.col("n"), spread)
    scored = sums.withColumn("ncc", F.round(ncc, 9)).where((F.col("n") >= n_fixed * 0.1) & F.col("ncc").isNotNull())
    best = scored.groupBy(*keys).agg(F.max(F.struct("ncc", (-F.col("sx")).alias("x"), (-F.col("sy")).alias("y"), (-F.col("sz")).alias("z"), "n")).alias("m"))
    return best.select(*keys, *[(-F.col(f"m.{a}")).alias(f"s{a}") for a in "xyz"], "m.ncc", "m.n")


def stitch_columns(columns: DataFrame, estimates: DataFrame) -> DataFrame:
    """Add the running shift (dx, dy, dz) of each column from estimates (slice_id, column_id, ex, ey, ez, offset, z_offset).

    A column's step is the median of its estimates, negated, less its offsets; a column
    without estimates adds nothing.
    """
    medians = estimates.groupBy("slice_id", "column_id").agg(*[F.percentile(f"e{a}", 0.5).alias(f"m{a}") for a in "xyz"], F.first("offset").alias("offset"), F.first("z_offset").alias("z_offset"))
    df = columns.join(medians, ["slice_id", "column_id"], "left")
    steps = {"x": -F.col("mx") - F.col("offset"), "y": -F.col("my"), "z": -F.col("mz") - F.col("z_offset")}
    by = Window.partitionBy("slice_id").orderBy("column_id").rowsBetween(Window.unboundedPreceding, 0)
    return df.select(*columns.columns, *[F.sum(F.coalesce(steps[a], F.lit(0.0))).over(by).alias(f"d{a}") for a in "xyz"])


def stitched_affine(columns: DataFrame, estimates: DataFrame) -> DataFrame:
    """``columns`` (slice_id, channel_id, column_id, params, pos0_x, raw_x) with ``params`` after stitching.

    A registered column is moved by (pos0_x - raw_x, 0, 0) before its matrix and by the running
    sum of the steps of ``stitch_columns`` after it. Column 0 gets the first move only; a column
    without estimates (slice_id, column_id, ...) keeps its map and adds nothing to the sum.
    """
    keys = ["slice_id", "channel_id", "column_id"]
    shifts = stitch_columns(columns.select("slice_id", "column_id").distinct(), estimates)
    done = estimates.select("slice_id", "column_id").distinct().withColumn("_done", F.lit(True))
    df = columns.join(shifts, ["slice_id", "column_id"]).join(done, ["slice_id", "column_id"], "left")
    before, p = F.col("pos0_x") - F.col("raw_x"), F.col("params")
    moved = [p[9 + r] + p[3 * r] * before for r in range(3)]
    first, registered = F.col("column_id") == 0, F.col("_done").isNotNull()
    last = [F.when(first, moved[r]).when(registered, moved[r] + F.col(f"d{a}")).otherwise(p[9 + r]) for r, a in enumerate("xyz")]
    params = F.concat(F.slice(p, 1, 9), F.array(*last))
    return df.select(*keys, *[params.alias(c) if c == "params" else F.col(c) for c in columns.columns if c not in keys])


def frame_shares(frames: DataFrame, pairs: DataFrame) -> DataFrame:
    """(slice_id, column_id, c, left, right): shares of background at each threshold for the two frames of a candidate.

    ``frames`` (slice_id, column_id, frame, x, v) are thumbnail pixels; ``pairs`` (slice_id,
    column_id, x1, x2, z_offset, n_frames) name the later column of a pair. Frame c of the
    earlier column counts from x1 on, frame c - z_offset of the later one up to x2. Candidates
    stand 100 frames apart; a frame without pixels in its crop is all background.
    """
    z, n = F.col("z_offset"), F.col("n_frames")
    start, stop = 100 + F.least(z, F.lit(0)), n - 100 - F.least(-z, F.lit(0))
    wanted = pairs.where(start < stop).withColumn("c", F.explode(F.sequence(start, stop - 1, F.lit(100))))
    out = wanted.select("slice_id", "column_id", "c")
    sides = {"left": (F.col("column_id") - 1, F.col("c"), F.col("x") >= F.col("x1")), "right": (F.col("column_id"), F.col("c") - z, F.col("x") < F.col("x2"))}
    for name, (column, frame, crop) in sides.items():
        at = wanted.select("slice_id", column.cast("int").alias("_column"), frame.cast("int").alias("frame"), "column_id", "c", "x1", "x2")
        pixels = frames.withColumnRenamed("column_id", "_column").join(at, ["slice_id", "_column", "frame"]).where(crop)
        shares = [F.avg(F.when((F.col("v") >= 0) & (F.col("v") <= t), 1.0).otherwise(0.0)) for t in BACKGROUND_THRESHOLDS]
        per = pixels.groupBy("slice_id", "column_id", "c").agg(F.array(*shares).alias(name))
        out = out.join(per, ["slice_id", "column_id", "c"], "left").withColumn(name, F.coalesce(name, F.array(*[F.lit(1.0) for _ in BACKGROUND_THRESHOLDS])))
    return out


def registration_windows(shares: DataFrame, pairs: DataFrame, registered: DataFrame, symmetric: bool = True) -> DataFrame:
    """The first window of each pair whose registration succeeds (slice_id, column_id, threshold, frame, start, stop, start_2, stop_2, tried).

    ``shares`` come from ``frame_shares``; ``registered`` (slice_id, column_id, c, ok) tells
    where a registration succeeds, and candidates that it doesn't name fail. Thresholds are
    gone through in order, and the candidates of each in order: background moves on by 100
    frames, a failed registration by 200, the first success ends the walk. ``tried`` counts
    the registrations. The window is c - 100 to c + 100 in the earlier column and the same
    less z_offset in the later one; not ``symmetric``, its upper end there is c + 100.

    Candidates of a pair are one short array, which is folded with the walk as its state.
    """
    keys = ["slice_id", "column_id"]
    n = len(BACKGROUND_THRESHOLDS)
    known = shares.join(registered.select(*keys, "c", "ok"), [*keys, "c"], "left")
    worst = F.zip_with("left", "right", lambda a, b: F.greatest(a, b))
    one = F.struct(F.col("c").cast("long").alias("c"), worst.alias("share"), F.coalesce("ok", F.lit(False)).alias("ok"))
    walks = known.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("all"))
    steps = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.transform("all", lambda x: F.struct(k.alias("k"), x["c"].alias("c"), F.get(x["share"], k).alias("share"), x["ok"].alias("ok")))))
    none = F.lit(None).cast("long")
    state = lambda k, next_c, found, tried: F.struct(k.cast("int").alias("k"), next_c.cast("long").alias("next"), found.cast("long").alias("found"), tried.cast("int").alias("tried"))

    def walk(s: F.Column, x: F.Column) -> F.Column:
        next_c = F.when(s["k"] == x["k"], s["next"]).otherwise(x["c"])  # a new threshold begins at its first candidate
        return (
            F.when(s["found"].isNotNull(), s)
            .when(x["c"] < next_c, state(x["k"], next_c, none, s["tried"]))
            .when(x["share"] > BACKGROUND_SHARE, state(x["k"], x["c"] + 100, none, s["tried"]))
            .when(x["ok"], state(x["k"], x["c"], x["c"], s["tried"] + 1))
            .otherwise(state(x["k"], x["c"] + 200, none, s["tried"] + 1))
        )

    ended = walks.select(*keys, F.aggregate(steps, state(F.lit(-1), F.lit(0), none, F.lit(0)), walk).alias("w")).where("w.found is not null")
    c, z = F.col("w.found"), F.col("z_offset")
    threshold = F.element_at(F.array(*map(F.lit, BACKGROUND_THRESHOLDS)), F.col("w.k") + 1)
    later = (c - 100 - z, c + 100 - z if symmetric else c + 100)
    return ended.join(pairs.select(*keys, "z_offset"), keys).select(*keys, threshold.alias("threshold"), c.alias("frame"), (c - 100).alias("start"), (c + 100).alias("stop"), later[0].alias("start_2"), later[1].alias("stop_2"), F.col("w.tried").alias("tried"))


def joint_histogram(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, a, b, c): how often each pair of bins meets."""
    return pairs.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("c"))


def mutual_information(joint: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, mi) of joint histograms (keys, a, b, c), with marginals by windows on them."""
    w = lambda *k: F.sum("c").over(Window.partitionBy(*keys, *k))
    df = joint.withColumn("n", w()).withColumn("ca", w("a")).withColumn("cb", w("b"))
    return df.groupBy(*keys, "n").agg(F.sum(F.col("c") / F.col("n") * F.ln(F.col("c") * F.col("n") / (F.col("ca") * F.col("cb")))).alias("mi"))


def best_by_information(scores: DataFrame, group: list[str], params: list[str]) -> DataFrame:
    order = F.struct(F.round("mi", 9).alias("mi"), *[(-F.col(p)).alias(p) for p in params])
    return scores.groupBy(*group).agg(F.max(order).alias("m")).select(*group, *[(-F.col(f"m.{p}")).alias(p) for p in params], "m.mi")


def align_channel(reference: DataFrame, moving: DataFrame, keys: list[str], ranges: list[tuple[int, int]], bin_width: int) -> DataFrame:
    """Shift of a channel to the reference channel with the largest mutual information."""
    a = reference.select(*keys, "z", "y", "x", F.floor(F.col("v") / bin_width).alias("a")).withColumn("s", F.explode(_shifts(*ranges))).select("*", "s.*").drop("s")
    at = a.select(*keys, "sx", "sy", "sz", (F.col("z") + F.col("sz")).alias("z"), (F.col("y") + F.col("sy")).alias("y"), (F.col("x") + F.col("sx")).alias("x"), "a")
    both = at.join(moving.select(*keys, "z", "y", "x", F.floor(F.col("v") / bin_width).alias("b")), [*keys, "z", "y", "x"])
    return best_by_information(mutual_information(joint_histogram(both, [*keys, "sx", "sy", "sz"]), [*keys, "sx", "sy", "sz"]), keys, ["sx", "sy", "sz"])


def surface_pairs(surfaces: DataFrame) -> DataFrame:
    """(slice_id, lower, upper, last): lower surface of slice - 1 with the upper one of a slice; a row for ends too."""
    lower = surfaces.where("side = 'l'").select((F.col("slice_id") + 1).alias("slice_id"), F.col("path").alias("lower"))
    upper = surfaces.where("side = 'u'").select("slice_id", F.col("path").alias("upper"))
    pairs = upper.join(lower, "slice_id", "left").select("slice_id", "lower", "upper", F.lit(False).alias("last"))
    ends = lower.join(upper, "slice_id", "left_anti").select("slice_id", "lower", F.lit(None).cast("string").alias("upper"), F.lit(True).alias("last"))
    return pairs.union(ends)


def surface_pair_lists(surfaces: DataFrame, channels: DataFrame, reference: str) -> DataFrame:
    """(slice_id, channel_id, lower, upper, last): what each slice of the reference channel is aligned with.

    ``surfaces`` (slice_id, channel_id, side, path) and ``channels`` (channel_id, channel_ord),
    the few channels to stitch by. A slice has one row without a channel: the upper surfaces of
    all channels in their order, and the lower ones of the slice just before it, null if the
    reference channel has no such slice. Where no slice follows there is a row for each channel
    with its lower surface alone. An absent surface is null in its place in a list.
    """
    refs = surfaces.where(F.col("channel_id") == reference).select("slice_id").distinct()
    order = channels.agg(F.collect_list(F.struct("channel_id", "channel_ord")).alias("c"))  # one row of a handful of channels
    wanted = refs.join(F.broadcast(order), F.lit(True)).select("slice_id", F.inline("c"))
    sides = surfaces.groupBy("slice_id", "channel_id").agg(*[F.max(F.when(F.col("side") == s, F.col("path"))).alias(s) for s in "ul"])
    lists = wanted.join(sides, ["slice_id", "channel_id"], "left")
    ordered = lambda side: F.transform(F.sort_array(F.collect_list(F.struct("channel_ord", side))), lambda x: x[side])
    by = lists.groupBy("slice_id").agg(ordered("u").alias("upper"), ordered("l").alias("own_lower"))
    before = by.select((F.col("slice_id") + 1).alias("slice_id"), F.col("own_lower").alias("lower"))
    none = F.lit(None)
    pairs = by.join(before, "slice_id", "left").select("slice_id", none.cast("string").alias("channel_id"), "lower", "upper", F.lit(False).alias("last"))
    following = refs.select((F.col("slice_id") - 1).alias("slice_id"))
    ends = lists.join(following, "slice_id", "left_anti").select("slice_id", "channel_id", F.array("l").alias("lower"), none.cast("array<string>").alias("upper"), F.lit(True).alias("last"))
    return pairs.union(ends)


def rigid_align(fixed: DataFrame, moving: DataFrame, keys: list[str], angles: list[float], reach: int, centre: tuple[float, float], bin_width: int) -> DataFrame:
    """Rotation and shift of 2-D images with the largest mutual information, nearest pixel; ``channel`` metrics add up.

    Candidates are angle number and integer shifts.
    """
    candidates = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(round(math.cos(t), 12)).alias("c"), F.lit(round(math.sin(t), 12)).alias("s")) for k, t in enumerate(angles)])
    a = fixed.select(*keys, "channel", "y", "x", F.floor(F.col("v") / bin_width).alias("a")).withColumn("t", F.explode(candidates))
    shift = F.sequence(F.lit(-reach), F.lit(reach))
    a = a.withColumn("sx", F.explode(shift)).withColumn("sy", F.explode(shift))
    px, py = F.col("x") - centre[0], F.col("y") - centre[1]
    nx = F.floor(F.round(px * F.col("t.c") - py * F.col("t.s") + centre[0] + F.col("sx"), 6) + 0.5).cast("int")
    ny = F.floor(F.round(px * F.col("t.s") + py * F.col("t.c") + centre[1] + F.col("sy"), 6) + 0.5).cast("int")
    at = a.select(*keys, "channel", F.col("t.k").alias("k"), "sx", "sy", nx.alias("x"), ny.alias("y"), "a")
    both = at.join(moving.select(*keys, "channel", "y", "x", F.floor(F.col("v") / bin_width).alias("b")), [*keys, "channel", "y", "x"])
    scores = mutual_information(joint_histogram(both, [*keys, "channel", "k", "sx", "sy"]), [*keys, "channel", "k", "sx", "sy"]).groupBy(*keys, "k", "sx", "sy").agg(F.sum("mi").alias("mi"))
    return best_by_information(scores, keys, ["k", "sx", "sy"])


def nonrigid_align(fixed: DataFrame, moving: DataFrame, keys: list[str], cell: int, reach: int) -> DataFrame:
    """(keys, cy, cx, sx, sy): for each control cell the local shift with the smallest mean squared difference.

    A cell is a row with its fixed pixels and the moving ones within ``reach``, so a pixel is
    shuffled once for each cell that sees it and not once for each shift. The pixels of an Arrow
    batch that a cell sees become one row before they are sorted by cells, which keeps tasks small.
    """
    places = [*keys, "cy", "cx"]
    side = cell + 2 * reach

    def packed(images: DataFrame, margin: int, name: str) -> DataFrame:
        df = images.select(*keys, "y", "x", F.col("v").cast("double").alias("v")).where("v is not null")
        kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                y, x = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in "yx")
                low, high = ([(c + o) // cell for c in (y, x)] for o in (-margin, margin))
                spread = range(2 * margin // cell + 2)  # a pixel is seen by at most so many cells along an axis
                seen = [(np.flatnonzero((low[0] + a <= high[0]) & (low[1] + b <= high[1])), a, b) for a in spread for b in spread]
                row = np.concatenate([r for r, _, _ in seen])
                cy, cx = (np.concatenate([low[n][part[0]] + part[1 + n] for part in seen]) for n in (0, 1))
                codes = [batch.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[row] for k in keys]
                order = np.lexsort((cx, cy, *codes))
                row, by = row[order], [c[order] for c in (cy, cx, *codes)]
                starts = np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in by], axis=0))))
                at = (y[row] - by[0] * cell + reach) * side + x[row] - by[1] * cell + reach
                offsets = pa.array(np.append(starts, len(row)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, v) for v in (pa.array(at.astype(np.int32)), batch.column("v").take(pa.array(row)))]
                cells = [pa.array(c[starts].astype(np.int32)) for c in by[:2]]
                yield pa.RecordBatch.from_arrays([*batch.select(keys).take(pa.array(row[starts])).columns, *cells, *lists], [*places, "at", "v"])

        seen = df.mapInArrow(pack, kinds + "cy int, cx int, at array<int>, v array<double>")
        return seen.groupBy(*places).agg(F.collect_list(F.struct("at", "v")).alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Number, sum and sum of squares of the pixels at each place, as a place may have several rows.
            sums = []
            for name in ("fixed", "moving"):
                parts = batch.column(name)
                row = np.repeat(np.arange(len(parts)), parts.value_lengths().to_numpy(zero_copy_only=False))
                places_of, values = parts.flatten().flatten()
                row = np.repeat(row, places_of.value_lengths().to_numpy(zero_copy_only=False))
                v = values.flatten().to_numpy(zero_copy_only=False)
                at = row * side * side + places_of.flatten().to_numpy(zero_copy_only=False)
                sums.append([np.bincount(at, w, batch.num_rows * side * side).reshape(-1, side, side) for w in (np.ones(len(v)), v, v * v)])
            inner = slice(reach, reach + cell)
            n_a, s_a, q_a = (f[:, inner, inner] for f in sums[0])
            for sy in range(2 * reach + 1):
                for sx in range(2 * reach + 1):
                    n_b, s_b, q_b = (f[:, sy : sy + cell, sx : sx + cell] for f in sums[1])
                    n, apart = (n_a * n_b).sum(axis=(1, 2)), (n_b * q_a - 2 * s_a * s_b + n_a * q_b).sum(axis=(1, 2))
                    some = np.flatnonzero(n)
                    shift = [pa.array(np.full(len(some), s - reach, np.int32)) for s in (sx, sy)]
                    yield pa.RecordBatch.from_arrays([*batch.select(places).take(pa.array(some)).columns, *shift, pa.array(apart[some] / n[some])], [*places, "sx", "sy", "e"])

    both = packed(fixed, 0, "fixed").join(packed(moving, reach, "moving"), places)
    kinds = "".join(f"`{k}` {fixed.schema[k].dataType.simpleString()}, " for k in keys)
    scores = both.mapInArrow(run, kinds + "cy int, cx int, sx int, sy int, e double")
    best = scores.groupBy(*places).agg(F.min(F.struct(F.round("e", 6).alias("e"), F.abs("sx") + F.abs("sy"), "sx", "sy")).alias("m"))
    return best.select(*places, "m.sx", "m.sy")


def smooth_cells(cells: DataFrame, keys: list[str], weight: float) -> DataFrame:
    """Cell shifts drawn to the average of their neighbours by a weight in [0, 1]."""
    around = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1))])
    near = cells.withColumn("o", F.explode(around)).select(*keys, (F.col("cy") + F.col("o.dy")).alias("cy"), (F.col("cx") + F.col("o.dx")).alias("cx"), "sx", "sy")
    means = near.groupBy(*keys, "cy", "cx").agg(F.avg("sx").alias("mx"), F.avg("sy").alias("my"))
    mix = lambda s, m: (F.col(s) * (1 - weight) + F.coalesce(m, s) * weight).alias(s)
    return cells.join(means, [*keys, "cy", "cx"], "left").select(*keys, "cy", "cx", mix("sx", "mx"), mix("sy", "my"))


def anchor_points(scores: DataFrame, points: DataFrame, keys: list[str], weight: float) -> DataFrame:
    """Scores of shifts (keys, sx, sy, mi) less weight times the distances of point pairs (keys, px, py, qx, qy)."""
    both = scores.join(points, keys)
    far = F.sqrt(F.pow(F.col("px") + F.col("sx") - F.col("qx"), 2) + F.pow(F.col("py") + F.col("sy") - F.col("qy"), 2))
    pulled = both.groupBy(*keys, "sx", "sy", "mi").agg(F.sum(far).alias("far"))
    return best_by_information(pulled.withColumn("mi", F.col("mi") - weight * F.col("far")), keys, ["sx", "sy"])

