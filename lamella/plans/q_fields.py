"""Queries on registration and displacement fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.operators import fields as o
from lamella.operators import geometry as g
from lamella.operators import register as r
from lamella.plans.catalog import query
from lamella.plans.q_geometry import _B, _affined, _boxes
from lamella.plans.q_manifest import _BUILT, built
from lamella.plans.q_volume import vox
from lamella.plans.views import FIELD_SQL, IMAGE_SQL, SLICES_SQL, field, images, slices, sql, view
from lamella.sources import store
from lamella.sources.cut import fresh_path

_V, _S = sql("vox"), sql("surf")
_GY = "(select cast(unnest(range(0, 8)) as int) gy), (select cast(unnest(range(0, 8)) as int) gx)"


def pixel_field(spark, sf_dir):
    """Displacements in grid pixels."""
    return field(spark, sf_dir).select("slice_id", "plane", "gy", "gx", (F.col("dx") / 40).alias("dx"), (F.col("dy") / 40).alias("dy"))


_PF = f"{_S}, {FIELD_SQL}, pf as (select slice_id, plane, gy, gx, dx / 40 dx, dy / 40 dy from field)"


@query(f"""with {_B}, o as (select *, lag(a01) over w pa01, lag(a12) over w pa12, lag(a20) over w pa20, lag(a22) over w pa22, lag(t0) over w pt0, lag(t2) over w pt2, lag(lo_x) over w plx, lag(lo_y) over w ply, lag(lo_z) over w plz, lag(hi_y) over w phy from tr window w as (partition by slice_id, channel_id order by column_id)),
q as (select slice_id, channel_id, column_id, spacing, pa01 * lo_y + pt0 x1, a01 * phy + t0 x2, a20 * lo_x + a22 * lo_z + t2 z2, pa20 * lo_x + pa22 * lo_z + pt2 z1 from o where pa01 is not null)
select slice_id, channel_id, column_id, round(x1, 6) x1, round(x2, 6) x2, cast(round_even(round(z2 - z1, 6), 0) as int) z_offset, round(x1 - trunc(round(x1 / spacing, 6)) * spacing, 6) offset_ from q""".replace(" offset_ from", ' "offset" from'))
def column_overlap(spark, sf_dir):
    out = r.column_overlap(_affined(spark, sf_dir))
    return out.select("slice_id", "channel_id", "column_id", *[F.round(c, 6).alias(c) for c in ("x1", "x2")], "z_offset", F.round("offset", 6).alias("offset"))


@query(f"""with {sql('frm')}, t as (select * from (values (0, 300.0), (1, 200.0), (2, 150.0), (3, 125.0), (4, 112.5)) t(k, t)),
s as (select slice_id, column_id, frame, k, t, avg(case when v between 0 and t then 1.0 else 0.0 end) s from frm, t group by all),
p as (select b.slice_id, b.column_id, b.k, b.t, b.frame c from s b join s a on a.slice_id = b.slice_id and a.column_id = b.column_id - 1 and a.frame = b.frame and a.k = b.k where b.frame = 100 and a.s <= 0.8 and b.s <= 0.8)
select slice_id, column_id, cast(min_by(t, k * 1000 + c) as double) threshold, min_by(c, k * 1000 + c) frame, min_by(c, k * 1000 + c) - 100 "start", min_by(c, k * 1000 + c) + 100 stop from p group by slice_id, column_id""")
def candidate_windows(spark, sf_dir):
    return r.candidate_windows(view(spark, sf_dir, "frm"), 200)


_NCC = f"""{_V}, a as (select slice_id, z, y, x, cast(v as double) a from vox where channel_id = '1'), b as (select slice_id, z, y, x, cast(v as double) b from vox where channel_id = '2'),
s as (select * from (select cast(unnest(range(-1, 2)) as int) sx), (select cast(unnest(range(-1, 2)) as int) sy), (select cast(unnest(range(-1, 2)) as int) sz))"""


@query(f"""with {_NCC},
q as (select a.slice_id, sx, sy, sz, count(*) n, sum(a) sa, sum(b) sb, sum(a * a) saa, sum(b * b) sbb, sum(a * b) sab from (select * from a, s) a join b on b.slice_id = a.slice_id and b.z = a.z + sz and b.y = a.y + sy and b.x = a.x + sx group by all),
e as (select *, round((sab - sa * sb / n) / nullif(sqrt((saa - sa * sa / n) * (sbb - sb * sb / n)), 0), 9) ncc from q where n >= 20)
select slice_id, sx, sy, sz, ncc, n from (select *, row_number() over (partition by slice_id order by ncc desc, sx, sy, sz) k from e where ncc is not null) where k = 1""")
def translation_ncc(spark, sf_dir):
    v = vox(spark, sf_dir)
    pick = lambda c: v.where(F.col("channel_id") == c).drop("channel_id")
    return r.translation_ncc(pick("1"), pick("2"), ["slice_id"], [(-1, 1)] * 3, 200)


@query(f"""with {sql('cols')}, e as (select cast(l_orderkey % 6 + 1 as int) slice_id, cast(l_suppkey % 4 as int) column_id, cast(l_partkey % 11 - 5 as double) ex, cast(l_suppkey % 7 - 3 as double) ey, cast(l_orderkey % 5 - 2 as double) ez from lineitem where l_suppkey % 4 > 0),
m as (select slice_id, column_id, median(ex) mx, median(ey) my, median(ez) mz from e group by all)
select slice_id, column_id, sum(coalesce(-mx - 0.25::double, 0)) over w dx, sum(coalesce(-my, 0)) over w dy, sum(coalesce(-mz - 2, 0)) over w dz from cols left join m using (slice_id, column_id) window w as (partition by slice_id order by column_id rows unbounded preceding)""")
def stitch_columns(spark, sf_dir):
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_suppkey % 4 > 0")
    d = lambda e: F.expr(f"cast({e} as double)")
    est = line.select(F.expr("cast(l_orderkey % 6 + 1 as int)").alias("slice_id"), F.expr("cast(l_suppkey % 4 as int)").alias("column_id"), d("l_partkey % 11 - 5").alias("ex"), d("l_suppkey % 7 - 3").alias("ey"), d("l_orderkey % 5 - 2").alias("ez"), F.lit(0.25).alias("offset"), F.lit(2).alias("z_offset"))
    return r.stitch_columns(view(spark, sf_dir, "cols").select("slice_id", "column_id"), est)


def _mi(keys: str, src: str) -> str:
    return f"j as (select {keys}, a, b, count(*) c from {src} group by all), k as (select *, sum(c) over (partition by {keys}) n, sum(c) over (partition by {keys}, a) ca, sum(c) over (partition by {keys}, b) cb from j), mi as (select {keys}, round(sum(c / n * ln(c * n / (ca * cb))), 9) mi from k group by {keys})"


@query(f"with {_NCC}, p as (select a.slice_id, sx, sy, sz, cast(floor(a / 512) as int) a, cast(floor(b / 512) as int) b from (select * from a, s) a join b on b.slice_id = a.slice_id and b.z = a.z + sz and b.y = a.y + sy and b.x = a.x + sx), {_mi('slice_id, sx, sy, sz', 'p')} select slice_id, sx, sy, sz, mi from (select *, row_number() over (partition by slice_id order by mi desc, sx, sy, sz) r from mi) where r = 1")
def align_channel(spark, sf_dir):
    v = vox(spark, sf_dir)
    pick = lambda c: v.where(F.col("channel_id") == c).drop("channel_id")
    return r.align_channel(pick("1"), pick("2"), ["slice_id"], [(-1, 1)] * 3, 512)


@query(f"""with {_BUILT}, s as (select slice_id, min(path) path from acq where slice_id not in (3, 7) group by all), u as (select slice_id, 'u' || path upper from s), lw as (select slice_id + 1 slice_id, 'l' || path lower from s)
select slice_id, lower, upper, false "last" from u left join lw using (slice_id) union all select slice_id, lower, null, true from lw where slice_id not in (select slice_id from u)""")
def surface_pairs(spark, sf_dir):
    s = built(spark, sf_dir)[1].where("slice_id not in (3, 7)").groupBy("slice_id").agg(F.min("path").alias("path"))
    sides = s.select("slice_id", F.explode(F.array(F.lit("u"), F.lit("l"))).alias("side"), "path")
    return r.surface_pairs(sides.withColumn("path", F.concat("side", "path")))


@query(f"""with {_BUILT}, refs as (select distinct slice_id from acq where channel_id = '1'), ap as (select slice_id, channel_id, min(path) path from acq group by all),
wt as (select slice_id, channel_id, channel_ord, path from refs cross join ch left join ap using (slice_id, channel_id)),
li as (select slice_id, string_agg(coalesce('u' || path, '-'), '|' order by channel_ord) u, string_agg(coalesce('l' || path, '-'), '|' order by channel_ord) l from wt group by slice_id)
select li.slice_id, cast(null as varchar) channel_id, p.l lower, li.u upper, false "last" from li left join li p on p.slice_id = li.slice_id - 1
union all select slice_id, channel_id, coalesce('l' || path, '-'), null, true from wt where slice_id + 1 not in (select slice_id from refs)""")
def surface_pair_lists(spark, sf_dir):
    channels, acquisitions, _ = built(spark, sf_dir)
    s = acquisitions.groupBy("slice_id", "channel_id").agg(F.min("path").alias("path"))
    sides = s.select("slice_id", "channel_id", F.explode(F.array(F.lit("u"), F.lit("l"))).alias("side"), "path").withColumn("path", F.concat("side", "path"))
    text = lambda c: F.when(F.col(c).isNotNull(), F.array_join(c, "|", "-")).alias(c)
    return r.surface_pair_lists(sides, channels, "1").select("slice_id", "channel_id", text("lower"), text("upper"), "last")


def _faces(spark, sf_dir):
    """Upper surface of a slice and lower one of the slice before, as fixed and moving images."""
    i = images(spark, sf_dir).withColumn("channel", F.lit("1"))
    return i.where("surface = 0").drop("surface"), i.where("surface = 1").withColumn("slice_id", F.col("slice_id") + 1).drop("surface")


_FACES = f"{_S}, {IMAGE_SQL}, fx as (select slice_id, y, x, v from img where surface = 0), mv as (select slice_id + 1 slice_id, y, x, v from img where surface = 1)"
_ANGLES = [-0.1, 0.0, 0.1]


@query(f"""with {_FACES}, t as (select * from (values (0, round(cos(-0.1), 12), round(sin(-0.1), 12)), (1, 1.0::double, 0.0::double), (2, round(cos(0.1), 12), round(sin(0.1), 12))) t(k, c, s)),
q as (select slice_id, k, sx, sy, cast(floor(round((x - 3.5::double) * c - (y - 3.5::double) * s + 3.5 + sx, 6) + 0.5) as int) nx, cast(floor(round((x - 3.5::double) * s + (y - 3.5::double) * c + 3.5 + sy, 6) + 0.5) as int) ny, v from fx, t, (select cast(unnest(range(-1, 2)) as int) sx), (select cast(unnest(range(-1, 2)) as int) sy)),
p as (select q.slice_id, k, sx, sy, q.v // 40 a, mv.v // 40 b from q join mv on mv.slice_id = q.slice_id and mv.x = nx and mv.y = ny), {_mi('slice_id, k, sx, sy', 'p').replace('k as (select *', 'kk as (select *').replace('from k group', 'from kk group')}
select slice_id, k, sx, sy, mi from (select *, row_number() over (partition by slice_id order by mi desc, k, sx, sy) r from mi) where r = 1""")
def rigid_align(spark, sf_dir):
    fixed, moving = _faces(spark, sf_dir)
    return r.rigid_align(fixed, moving, ["slice_id"], _ANGLES, 1, (3.5, 3.5), 40)


_CELLS = f"""{_FACES}, q as (select fx.slice_id, fx.y // 4 cy, fx.x // 4 cx, sx, sy, round(avg((fx.v - mv.v) * (fx.v - mv.v)), 6) e from (select * from fx, (select cast(unnest(range(-2, 3)) as int) sx), (select cast(unnest(range(-2, 3)) as int) sy)) fx join mv on mv.slice_id = fx.slice_id and mv.y = fx.y + sy and mv.x = fx.x + sx group by all),
ce as (select slice_id, cy, cx, sx, sy from (select *, row_number() over (partition by slice_id, cy, cx order by e, abs(sx) + abs(sy), sx, sy) k from q) where k = 1)"""


@query(f"with {_CELLS} select * from ce")
def nonrigid_align(spark, sf_dir):
    fixed, moving = _faces(spark, sf_dir)
    return r.nonrigid_align(fixed, moving, ["slice_id"], 4, 2)


@query(f"with {_CELLS} select a.slice_id, a.cy, a.cx, round(a.sx * 0.5::double + avg(b.sx) * 0.5::double, 6) sx, round(a.sy * 0.5::double + avg(b.sy) * 0.5::double, 6) sy from ce a join ce b on b.slice_id = a.slice_id and abs(a.cy - b.cy) + abs(a.cx - b.cx) = 1 group by a.slice_id, a.cy, a.cx, a.sx, a.sy")
def smooth_cells(spark, sf_dir):
    fixed, moving = _faces(spark, sf_dir)
    out = r.smooth_cells(r.nonrigid_align(fixed, moving, ["slice_id"], 4, 2), ["slice_id"], 0.5)
    return out.select("slice_id", "cy", "cx", F.round("sx", 6).alias("sx"), F.round("sy", 6).alias("sy"))


@query(f"""with {sql('pts')}, pp as (select cast(point_id % 6 + 1 as int) slice_id, x px, y py, x + point_id % 3 qx, y - point_id % 2 qy from pts),
s as (select * from (select cast(unnest(range(-2, 3)) as int) sx), (select cast(unnest(range(-2, 3)) as int) sy)),
e as (select slice_id, sx, sy, round((sx + sy) * 0.5::double - 0.1::double * sum(sqrt((px + sx - qx) * (px + sx - qx) + (py + sy - qy) * (py + sy - qy))), 9) mi from pp, s group by slice_id, sx, sy)
select slice_id, sx, sy, round(mi, 6) mi from (select *, row_number() over (partition by slice_id order by mi desc, sx, sy) k from e) where k = 1""")
def anchor_points(spark, sf_dir):
    p = view(spark, sf_dir, "pts").select((F.col("point_id") % 6 + 1).cast("int").alias("slice_id"), F.col("x").alias("px"), F.col("y").alias("py"), (F.col("x") + F.col("point_id") % 3).alias("qx"), (F.col("y") - F.col("point_id") % 2).alias("qy"))
    seq = F.sequence(F.lit(-2), F.lit(2))
    scores = p.select("slice_id").distinct().withColumn("sx", F.explode(seq)).withColumn("sy", F.explode(seq)).withColumn("mi", (F.col("sx") + F.col("sy")) * 0.5)
    return r.anchor_points(scores, p, ["slice_id"], 0.1).withColumn("mi", F.round("mi", 6))


@query(f"with {_PF} select slice_id, gy, gx, round((gx - 3) * cos(0.2) - (gy - 4) * sin(0.2) + 3 + 1 - gx, 6) dx, round((gx - 3) * sin(0.2) + (gy - 4) * cos(0.2) + 4 - 2 - gy, 6) dy from pf where plane = 0")
def transform_to_field(spark, sf_dir):
    grid = pixel_field(spark, sf_dir).where("plane = 0").select("slice_id", "gy", "gx")
    return o.transform_to_field(grid, 0.2, (1.0, -2.0), (3.0, 4.0)).withColumn("dx", F.round("dx", 6)).withColumn("dy", F.round("dy", 6))


_CO = f"""{_PF}, ats as (select slice_id, gy, gx, dx ex, dy ey, gx + dx px, gy + dy py from pf where plane = 1), ci as (select *, least(greatest(px, 0), 7) cx, least(greatest(py, 0), 7) cy from ats where px >= -0.5 and px < 7.5 and py >= -0.5 and py < 7.5),
cw as (select *, floor(cx) + i kx, floor(cy) + j ky, (case i when 1 then cx - floor(cx) else 1 - cx + floor(cx) end) * (case j when 1 then cy - floor(cy) else 1 - cy + floor(cy) end) w from ci, (select unnest([0, 1]) i), (select unnest([0, 1]) j))"""


@query(f"with {_CO}, su as (select cw.slice_id, cw.gy, cw.gx, sum(w * pf.dx) fx, sum(w * pf.dy) fy from cw join pf on pf.slice_id = cw.slice_id and pf.plane = 0 and pf.gx = kx and pf.gy = ky where w > 0 group by all) select slice_id, gy, gx, round(ex + coalesce(fx, 0), 6) dx, round(ey + coalesce(fy, 0), 6) dy from ats left join su using (slice_id, gy, gx)")
def compose_fields(spark, sf_dir):
    f = pixel_field(spark, sf_dir)
    pick = lambda k: f.where(F.col("plane") == k).drop("plane")
    out = o.compose_fields(pick(0), pick(1), ["slice_id"], 8, 8)
    return out.select("slice_id", "gy", "gx", F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"))


@query(f"with {_CO}, su as (select cw.slice_id, cw.gy, cw.gx, sum(w * pf.dx) dz from cw join pf on pf.slice_id = cw.slice_id and pf.plane = 0 and pf.gx = kx and pf.gy = ky where w > 0 group by all) select slice_id, gy, gx, round(ex, 6) dx, round(ey, 6) dy, round(coalesce(dz, 0), 6) dz from ats left join su using (slice_id, gy, gx)")
def combine_xy_z(spark, sf_dir):
    f = pixel_field(spark, sf_dir)
    z = f.where("plane = 0").select("slice_id", "gy", "gx", F.col("dx").alias("dz"))
    out = o.combine_xy_z(f.where("plane = 1").drop("plane"), z, ["slice_id"], 8, 8)
    return out.select("slice_id", "gy", "gx", *[F.round(c, 6).alias(c) for c in ("dx", "dy", "dz")])


@query("""with e as (select s_suppkey % 50 n, case when s_suppkey % 3 = 0 then 'xy' else 'z' end || '_' || case when s_suppkey % 2 = 0 then 'u' else 'l' end k, max(s_name) p from supplier group by all)
select cast(n as int) slice_id, max(case when k = 'xy_l' then p end) xy_u, max(case when k = 'xy_l' then p end) xy_l, max(case when k = 'z_l' then p end) z_u, max(case when k = 'z_l' then p end) z_l from e group by n""")
def split_transforms(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.concat_ws(",", (F.col("s_suppkey") % 50).cast("string"), F.when(F.col("s_suppkey") % 3 == 0, "xy").otherwise("z"), F.when(F.col("s_suppkey") % 2 == 0, "u").otherwise("l"))
    return o.split_transforms(s.groupBy(key.alias("key")).agg(F.max("s_name").alias("path")), nonrigid=False)


@query(f"with {_PF}, {SLICES_SQL} select slice_id, plane, gy, gx, round(dx * 4, 6) dx, round(dy * 4, 6) dy, round(lo_z - (slice_id - 1 + plane) * 300, 6) dz from pf join slices using (slice_id)")
def build_brain(spark, sf_dir):
    out = o.build_brain(pixel_field(spark, sf_dir).withColumn("dz", F.lit(0.0)), slices(spark), 4.0, 300.0, 200, 200)[1]
    return out.select("slice_id", "plane", "gy", "gx", *[F.round(c, 6).alias(c) for c in ("dx", "dy", "dz")])


@query(f"""with {_PF}, {SLICES_SQL} select slice_id, plane, gy, gx, round(dx * 4, 6) dx, round(dy * 4, 6) dy, round(lo_z - (slice_id - 1 + plane) * 300, 6) dz,
  cast((slice_id - 1) * 300 as double) lo_z, cast(slice_id * 300 as double) hi_z, cast(200 * 4 as double) hi_x from pf join slices using (slice_id)""")
def write_brain(spark, sf_dir):
    """A brain written and read back: its fields with the boxes of their slices."""
    path = fresh_path(spark, "brain")
    store.write_brain(*o.build_brain(pixel_field(spark, sf_dir).withColumn("dz", F.lit(0.0)), slices(spark), 4.0, 300.0, 200, 200), path)
    boxes, stored = store.read_brain(spark, path)
    out = stored.join(boxes, "slice_id")
    return out.select("slice_id", "plane", "gy", "gx", *[F.round(c, 6).alias(c) for c in ("dx", "dy", "dz")], "lo_z", "hi_z", "hi_x")


@query(f"with {_PF} select slice_id, plane, gy, gx, true converged, cast(gy as double) fy, cast(gx as double) fx from pf")
def invert_field(spark, sf_dir):
    """Inverse displacements; what is returned is where the field moves q + D'(q), which is q again."""
    f = pixel_field(spark, sf_dir)
    inverse = o.invert_field(f, tile=4).withColumnsRenamed({"dx": "ix", "dy": "iy"})
    keys = ["slice_id", "plane"]
    # Beyond the grid a field goes on with its border's values: look it up at the nearest place inside.
    at = inverse.select(*keys, "gy", "gx", "converged", (F.col("gx") + F.col("ix")).alias("x"), (F.col("gy") + F.col("iy")).alias("y"))
    inside = lambda c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(7.0))
    corners = g._corners(at.withColumnsRenamed({"gy": "ny", "gx": "nx"}), inside("x"), inside("y"), 8, 8).where("w > 0")
    seen = corners.join(f, [*keys, "gy", "gx"]).groupBy(*keys, "ny", "nx", "x", "y", "converged").agg(F.sum(F.col("w") * F.col("dx")).alias("mx"), F.sum(F.col("w") * F.col("dy")).alias("my"))
    return seen.select(*keys, F.col("ny").alias("gy"), F.col("nx").alias("gx"), "converged", *[(F.round(F.col(a) + F.col(f"m{a}"), 5) + 0.0).alias(f"f{a}") for a in "yx"])


def _inner_points(spark, sf_dir):
    """All points, drawn together so that they stand inside the fields, where every point has an inverse."""
    pts = view(spark, sf_dir, "pts").select("point_id", (F.col("x") * 0.8 + 50).alias("x"), (F.col("y") * 0.6 + 50).alias("y"), "z")
    return g.locate_slice(pts, slices(spark))


def _forward(back, spark, sf_dir):
    """The result of an inverse mapping sent forward again, to two decimals."""
    at = back.select("point_id", "slice_id", "converged", *[F.col(f"b{a}").alias(a) for a in "xyz"])
    out = g.apply_field(at, field(spark, sf_dir), 100.0, 8, 8, 300.0)
    return out.select("point_id", "slice_id", "converged", *[F.round(f"q{a}", 2).alias(a) for a in "xyz"])


_INNER = f"""{sql('pts')}, {SLICES_SQL}, p as (select point_id, round(x * 0.8::double + 50, 2) x, round(y * 0.6::double + 50, 2) y, z from pts),
b as (select p.*, coalesce((select arg_max(slice_id, lo_z) from slices s where s.lo_z <= p.z), 1) slice_id from p)"""


@query(f"with {_INNER} select point_id, slice_id, true converged, x, y, z from b")
def slice_to_brain(spark, sf_dir):
    """Points of slices mapped to the brain; what is returned is their map back to the slice."""
    return _forward(o.slice_to_brain(_inner_points(spark, sf_dir), field(spark, sf_dir), 100.0, 300.0, tile=4), spark, sf_dir)


@query(f"with {_INNER} select point_id, slice_id, true converged, x, y, z from b")
def column_to_brain(spark, sf_dir):
    """Points of slices as columns see them, mapped to the brain; what is returned is their map back to the slice."""
    boxes = _boxes(spark, sf_dir)
    at = g.locate_column(_inner_points(spark, sf_dir), boxes).select("point_id", "slice_id", "column_id", "px", "py", "frame")
    in_slice = g.column_to_slice(at, boxes).select("point_id", "slice_id", "x", "y", "z")
    return _forward(o.slice_to_brain(in_slice, field(spark, sf_dir), 100.0, 300.0, tile=4), spark, sf_dir)
