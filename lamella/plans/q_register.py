"""Queries on registration over the chunk store and over levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.operators import align as al
from lamella.operators import geometry as g
from lamella.operators import register as r
from lamella.operators import scores as sc
from lamella.plans.catalog import query
from lamella.plans.q_geometry import _B, _affined
from lamella.plans.q_volume import vox
from lamella.plans.views import sql, view
from lamella.sources import store
from lamella.sources.cut import cut

_KEYS = ["slice_id", "channel_id"]


def _channel_chunks(spark, sf_dir, size=8):
    """The reference channel once for each other channel, and those channels, as chunks."""
    v = vox(spark, sf_dir)
    others = F.explode(F.array(F.lit("2"), F.lit("3"))).alias("channel_id")
    fixed = v.where("channel_id = '1'").drop("channel_id").select("*", others)
    return store.from_voxels(fixed, _KEYS, size), store.from_voxels(v.where("channel_id <> '1'"), _KEYS, size)


_PAIRS = f"""{sql('vox')}, a0 as (select slice_id, c.channel_id, z, y, x, cast(v as double) v from vox, (select unnest(['2', '3']) channel_id) c where vox.channel_id = '1' and v > 0),
b0 as (select slice_id, channel_id, z, y, x, cast(v as double) v from vox where channel_id <> '1' and v > 0),
s as (select * from (select cast(unnest(range(-1, 2)) as int) sx), (select cast(unnest(range(-1, 2)) as int) sy), (select cast(unnest(range(-1, 2)) as int) sz))"""


def _level(k: int, base: str) -> str:
    """CTE items q{k}, e{k}, r{k}: sums, scores and the best shift of a level around ``base`` (slice_id, channel_id, bx, by_, bz)."""
    return f"""q{k} as (select a.slice_id, a.channel_id, bx + sx sx, by_ + sy sy, bz + sz sz, count(*) n, sum(a.v) sa, sum(b.v) sb, sum(a.v * a.v) saa, sum(b.v * b.v) sbb, sum(a.v * b.v) sab
  from a{k} a join {base} g on g.slice_id = a.slice_id and g.channel_id = a.channel_id cross join s
  join b{k} b on b.slice_id = a.slice_id and b.channel_id = a.channel_id and b.z = a.z + bz + sz and b.y = a.y + by_ + sy and b.x = a.x + bx + sx group by all),
e{k} as (select q.*, round((sab - sa * sb / n) / nullif(sqrt((saa - sa * sa / n) * (sbb - sb * sb / n)), 0), 9) ncc from q{k} q join (select slice_id, channel_id, count(*) nf from a{k} group by all) using (slice_id, channel_id) where n >= nf * cast(0.1 as double)),
r{k} as (select slice_id, channel_id, cast(sx as int) sx, cast(sy as int) sy, cast(sz as int) sz, ncc, n from (select *, row_number() over (partition by slice_id, channel_id order by ncc desc, sx, sy, sz) r from e{k} where ncc is not null) where r = 1)"""


_ZERO = "zero as (select distinct slice_id, channel_id, 0 bx, 0 by_, 0 bz from a0)"


@query(f"with {_PAIRS}, {_ZERO}, {_level(0, 'zero')} select * from r0")
def translation_ncc_chunks(spark, sf_dir):
    fixed, moving = _channel_chunks(spark, sf_dir)
    return sc.translation_ncc_chunks(fixed, moving, _KEYS, [(-1, 1)] * 3)


@query(f"""with {_PAIRS},
j as (select a.slice_id, a.channel_id, sx, sy, sz, floor(a.v / 512) x1, floor(b.v / 512) x2, count(*) c from a0 a cross join s join b0 b on b.slice_id = a.slice_id and b.channel_id = a.channel_id and b.z = a.z + sz and b.y = a.y + sy and b.x = a.x + sx group by all),
k as (select *, sum(c) over w n, sum(c) over (partition by slice_id, channel_id, sx, sy, sz, x1) ca, sum(c) over (partition by slice_id, channel_id, sx, sy, sz, x2) cb from j window w as (partition by slice_id, channel_id, sx, sy, sz)),
m as (select slice_id, channel_id, sx, sy, sz, round(sum(c / n * ln(c * n / (ca * cb))), 9) mi from k group by all)
select slice_id, channel_id, sx, sy, sz, mi from (select *, row_number() over (partition by slice_id, channel_id order by mi desc, sx, sy, sz) r from m) where r = 1""")
def align_channel_chunks(spark, sf_dir):
    fixed, moving = _channel_chunks(spark, sf_dir)
    return sc.align_channel_chunks(fixed, moving, _KEYS, [(-1, 1)] * 3, 512)


@query(f"""with {_PAIRS}, {_ZERO},
a1 as (select slice_id, channel_id, z // 2 z, y // 2 y, x // 2 x, floor(avg(v) + cast(0.5 as double)) v from a0 group by slice_id, channel_id, z // 2, y // 2, x // 2),
b1 as (select slice_id, channel_id, z // 2 z, y // 2 y, x // 2 x, floor(avg(v) + cast(0.5 as double)) v from b0 group by slice_id, channel_id, z // 2, y // 2, x // 2),
{_level(1, 'zero')}, g0 as (select z.slice_id, z.channel_id, 2 * coalesce(sx, 0) bx, 2 * coalesce(sy, 0) by_, 2 * coalesce(sz, 0) bz from zero z left join r1 using (slice_id, channel_id)),
{_level(0, 'g0')} select * from r0""")
def translation_coarse_to_fine(spark, sf_dir):
    """Two levels: the best shift of the halved volumes, then its surroundings on the full ones."""
    fixed, moving = _channel_chunks(spark, sf_dir)
    return sc.coarse_to_fine(fixed, moving, _KEYS, 2, 1)


_SIDE = 8
_STEP, _BIN, _CENTRE = 0.05, 40, (3.5, 3.5)


def _surfaces(spark, sf_dir, size=8):
    """Tiles of the previous lower, the following upper and a template surface of each slice, in two channels."""
    cells = view(spark, sf_dir, "surf").select("slice_id", "comp", F.posexplode("embedding").alias("k", "e")).where("k < 64")
    v = F.greatest(F.floor((F.col("e").cast("double") + 0.6) * 200).cast("int"), F.lit(0))
    img = cells.select("slice_id", F.expr("cast(comp div 2 + 1 as string)").alias("channel"), (F.col("comp") % 2).alias("surface"), F.expr("cast(k div 8 as int)").alias("y"), (F.col("k") % 8).alias("x"), v.alias("v"))
    upper = img.where("surface = 0").drop("surface")
    previous = img.where("surface = 1").drop("surface").withColumn("slice_id", F.col("slice_id") + 1)
    template = upper.withColumn("slice_id", F.col("slice_id") - 1).where("slice_id % 3 <> 0")
    return [cut(al.tiles(i, ["slice_id"], size)) for i in (previous, upper, template)]


_IMAGES = f"""{sql('surf')}, img as (select slice_id, cast(comp // 2 + 1 as varchar) channel, comp % 2 surface, cast(k // 8 as int) y, cast(k % 8 as int) x, greatest(cast(floor((cast(embedding[k + 1] as double) + 0.6) * 200) as int), 0) v
  from surf, (select cast(unnest(range(0, 64)) as int) k)),
pv as (select slice_id + 1 slice_id, channel, y, x, v from img where surface = 1), nx as (select slice_id, channel, y, x, v from img where surface = 0),
tm as (select slice_id - 1 slice_id, channel, y, x, v from nx where (slice_id - 1) % 3 <> 0),
mv0 as (select * from pv union all select * from nx where slice_id not in (select slice_id from pv)),
fx0 as (select * from tm union all select * from mv0 where slice_id not in (select slice_id from tm)),
{', '.join(f'{n}1 as (select slice_id, channel, y // 2 y, x // 2 x, cast(floor(avg(v) + cast(0.5 as double)) as int) v from {n}0 group by slice_id, channel, y // 2, x // 2)' for n in ('fx', 'mv'))},
d3 as (select cast(unnest([-1, 0, 1]) as int) d)"""


def _turned(level: int) -> str:
    c = _CENTRE[0] if level == 0 else (_CENTRE[0] - 0.5) / 2
    cos, sin = f"round(cos(k * {_STEP}::double), 12)", f"round(sin(k * {_STEP}::double), 12)"
    near = lambda e: f"cast(floor(round({e}, 6) + 0.5) as int)"
    return f"{near(f'(x - {c}::double) * {cos} - (y - {c}::double) * {sin} + {c} + sx')} nx, {near(f'(x - {c}::double) * {sin} + (y - {c}::double) * {cos} + {c} + sy')} ny"


def _rigid(level: int, candidates: str, keep: int) -> str:
    return f"""p{level} as (select q.slice_id, q.channel, k, sx, sy, q.v // {_BIN} a, m.v // {_BIN} b from (select f.*, k, sx, sy, {_turned(level)} from fx{level} f join {candidates} c using (slice_id)) q
  join mv{level} m on m.slice_id = q.slice_id and m.channel = q.channel and m.x = nx and m.y = ny),
j{level} as (select slice_id, channel, k, sx, sy, a, b, count(*) c from p{level} group by all),
w{level} as (select *, sum(c) over w n, sum(c) over (partition by slice_id, channel, k, sx, sy, a) ca, sum(c) over (partition by slice_id, channel, k, sx, sy, b) cb from j{level} window w as (partition by slice_id, channel, k, sx, sy)),
i{level} as (select slice_id, channel, k, sx, sy, sum(c / n * ln(c * n / (ca * cb))) mi from w{level} group by all),
o{level} as (select slice_id, k, sx, sy, round(sum(mi), 9) mi from i{level} group by slice_id, k, sx, sy),
best{level} as (select slice_id, k, sx, sy, mi from (select *, row_number() over (partition by slice_id order by mi desc, k, sx, sy) r from o{level}) where r <= {keep})"""


_FOUND = f"""{_IMAGES}, can1 as (select distinct slice_id, 2 * a.d k, b.d sx, c.d sy from fx0, d3 a, d3 b, d3 c), {_rigid(1, 'can1', 2)},
can0 as (select distinct slice_id, k + a.d k, 2 * sx + b.d sx, 2 * sy + c.d sy from best1, d3 a, d3 b, d3 c), {_rigid(0, 'can0', 1)}"""


def _found(spark, sf_dir):
    previous, following, template = _surfaces(spark, sf_dir)
    fixed, moving = (cut(al.first_of(["slice_id"], *i)) for i in ((template, previous, following), (previous, following)))
    return fixed, moving, al.rigid_levels(fixed, moving, ["slice_id"], 2, _STEP, 1, 1, _CENTRE, _BIN, beam=2)


@query(f"with {_FOUND} select * from best0")
def rigid_levels(spark, sf_dir):
    """Two levels, the two best candidates carried, both channels summed, template before previous before following."""
    return _found(spark, sf_dir)[2]


_SHIFTS = f"""{_FOUND}, s2 as (select a.d ex, b.d ey from (select cast(unnest(range(-2, 3)) as int) d) a, (select cast(unnest(range(-2, 3)) as int) d) b),
ats as (select f.slice_id, channel, y // 4 cy, x // 4 cx, v, {_turned(0)} from fx0 f join best0 using (slice_id)),
e as (select ats.slice_id, cy, cx, ex, ey, round(sum((ats.v - m.v) * (ats.v - m.v)) / count(*), 6) e from ats cross join s2 join mv0 m on m.slice_id = ats.slice_id and m.channel = ats.channel and m.x = nx + ex and m.y = ny + ey group by all),
ce as (select slice_id, cy, cx, cast(ex as double) sx, cast(ey as double) sy from (select *, row_number() over (partition by slice_id, cy, cx order by e, abs(ex) + abs(ey), ex, ey) r from e) where r = 1)"""


def _cells(spark, sf_dir):
    fixed, moving, found = _found(spark, sf_dir)
    return fixed, cut(al.local_shifts(fixed, moving, ["slice_id"], found, _STEP, _CENTRE, 4, 2))


@query(f"with {_SHIFTS} select * from ce")
def local_shifts(spark, sf_dir):
    return _cells(spark, sf_dir)[1]


_SMOOTH = f"""{_SHIFTS}, pe as (select slice_id, y // 4 cy, x // 4 cx, cast(0.2 as double) + cast(0.5 as double) * avg(case when v >= 121 then 1.0::double else 0.0::double end) w from fx0 where channel = '1' group by slice_id, y // 4, x // 4),
ne as (select a.slice_id, a.cy, a.cx, avg(b.sx) mx, avg(b.sy) my from ce a join ce b on b.slice_id = a.slice_id and abs(a.cy - b.cy) + abs(a.cx - b.cx) = 1 group by all),
sm as (select slice_id, cy, cx, (1 - w) * sx + w * coalesce(mx, sx) sx, (1 - w) * sy + w * coalesce(my, sy) sy from ce join pe using (slice_id, cy, cx) left join ne using (slice_id, cy, cx))"""


def _smoothed(spark, sf_dir):
    fixed, cells = _cells(spark, sf_dir)
    masks = al.pixels(fixed, ["slice_id"]).where("channel = '1'").withColumn("m", (F.col("v") >= 121).cast("int"))
    return al.smooth_penalised(cells, al.cell_penalties(masks, ["slice_id"], 4, 0.2, 0.7), ["slice_id"], 1)


@query(f"with {_SMOOTH} select slice_id, cy, cx, round(sx, 6) + 0 sx, round(sy, 6) + 0 sy from sm")
def smooth_penalised(spark, sf_dir):
    out = _smoothed(spark, sf_dir)
    return out.select("slice_id", "cy", "cx", *[(F.round(c, 6) + 0.0).alias(c) for c in ("sx", "sy")])


def _basis(axis: str) -> str:
    return f"case k{axis} when 0 then (1 - t{axis}) ** 3 when 1 then 3 * t{axis} ** 3 - 6 * t{axis} ** 2 + 4 when 2 then -3 * t{axis} ** 3 + 3 * t{axis} ** 2 + 3 * t{axis} + 1 else t{axis} ** 3 end / 6"


@query(f"""with {_SMOOTH}, g as (select slice_id, gy, gx, floor((gy + 0.5::double) / 4 - 0.5) fy, floor((gx + 0.5::double) / 4 - 0.5) fx, (gy + 0.5::double) / 4 - 0.5 - floor((gy + 0.5::double) / 4 - 0.5) ty, (gx + 0.5::double) / 4 - 0.5 - floor((gx + 0.5::double) / 4 - 0.5) tx
  from (select distinct slice_id from sm), (select cast(unnest(range(0, 8)) as int) gy), (select cast(unnest(range(0, 8)) as int) gx)),
b as (select *, ({_basis('y')}) * ({_basis('x')}) w, least(greatest(fy - 1 + ky, 0), 1) py, least(greatest(fx - 1 + kx, 0), 1) px from g, (select unnest(range(0, 4)) ky), (select unnest(range(0, 4)) kx))
select b.slice_id, gy, gx, round(sum(w * sx), 6) + 0 dx, round(sum(w * sy), 6) + 0 dy from b join sm on sm.slice_id = b.slice_id and cy = py and cx = px group by b.slice_id, gy, gx having count(*) = 16""")
def dense_field(spark, sf_dir):
    """The smoothed shifts of the control cells on every pixel."""
    out = al.dense_field(_smoothed(spark, sf_dir), ["slice_id"], 4, (_SIDE, _SIDE))
    return out.select("slice_id", "gy", "gx", *[(F.round(c, 6) + 0.0).alias(c) for c in ("dx", "dy")])  # no negative zeros


@query()
def align_surfaces(spark, sf_dir):
    """The whole chain: fields from each slice's template to its previous and its following surface."""
    previous, following, template = _surfaces(spark, sf_dir)
    out = al.align_surfaces(previous, following, template, ["slice_id"], (_SIDE, _SIDE), levels=2, step=_STEP, turns=1, reach=1, bin_width=_BIN, cell=4, local_reach=2, beam=2)
    return out.select("slice_id", "side", "gy", "gx", F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"))


_ESTIMATES_SQL = """est as (select cast(l_orderkey % 6 + 1 as int) slice_id, cast(l_suppkey % 4 as int) column_id, cast(l_partkey % 11 - 5 as double) ex, cast(l_suppkey % 7 - 3 as double) ey, cast(l_orderkey % 5 - 2 as double) ez from lineitem where l_suppkey % 4 > 0 and (l_orderkey % 6 + l_suppkey % 4) % 4 <> 1)"""


@query(f"""with {_B}, {_ESTIMATES_SQL}, m as (select slice_id, column_id, median(ex) mx, median(ey) my, median(ez) mz from est group by all),
st as (select tr.*, rw.rx, m.mx is not null ok, p0x - rw.rx pre, sum(coalesce(-mx - 0.25::double, 0)) over w dx, sum(coalesce(-my, 0)) over w dy, sum(coalesce(-mz - 2, 0)) over w dz
  from tr join rw using (slice_id, channel_id) left join m using (slice_id, column_id) window w as (partition by slice_id order by column_id rows unbounded preceding))
select slice_id, channel_id, column_id, round(a01, 6) a01, round(a12, 6) a12, round(a20, 6) a20, round(a22, 6) a22,
  round(t0 + case when column_id > 0 and ok then dx else 0 end, 6) + 0 t0, round(t1 + case when column_id > 0 and ok then dy else 0 end, 6) + 0 t1,
  round(t2 + case when column_id = 0 or ok then a20 * pre else 0 end + case when column_id > 0 and ok then dz else 0 end, 6) + 0 t2 from st""")
def stitched_affine(spark, sf_dir):
    """The maps of all columns after stitching; some columns have no estimate."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_suppkey % 4 > 0 and (l_orderkey % 6 + l_suppkey % 4) % 4 <> 1")
    d = lambda e: F.expr(f"cast({e} as double)")
    est = line.select(F.expr("cast(l_orderkey % 6 + 1 as int)").alias("slice_id"), F.expr("cast(l_suppkey % 4 as int)").alias("column_id"), d("l_partkey % 11 - 5").alias("ex"), d("l_suppkey % 7 - 3").alias("ey"), d("l_orderkey % 5 - 2").alias("ez"), F.lit(0.25).alias("offset"), F.lit(2).alias("z_offset"))
    columns = _affined(spark, sf_dir)
    raw = g.boxes_of(columns, ["slice_id", "channel_id"]).select("slice_id", "channel_id", F.col("lo_x").alias("raw_x"))
    out = r.stitched_affine(columns.join(raw, ["slice_id", "channel_id"]).select("slice_id", "channel_id", "column_id", "params", "pos0_x", "raw_x"), est)
    at = {"a01": 1, "a12": 5, "a20": 6, "a22": 8, "t0": 9, "t1": 10, "t2": 11}
    return out.select("slice_id", "channel_id", "column_id", *[(F.round(F.col("params")[k], 6) + 0.0).alias(n) for n, k in at.items()])


#: Pairs of columns with an overlap, an offset in frames and a number of frames each, and their thumbnails.
_WALK_FRAMES = ["cast(l_orderkey % 6 + 1 as int) slice_id", "cast(l_suppkey % 4 as int) column_id", "cast(l_partkey % 40 * 25 as int) frame", "cast(l_orderkey // 6 % 16 as int) x", "cast(cast(floor(l_extendedprice) as bigint) % (150 + l_partkey % 40 % 7 * 60) as int) v"]
_WALK_PAIRS = ["slice_id", "column_id", "cast(3 + column_id as int) x1", "cast(13 - column_id as int) x2", "cast((slice_id + column_id) % 3 * 25 - 25 as int) z_offset", "1000 n_frames"]


@query(f"""with recursive f as (select {', '.join(_WALK_FRAMES)} from lineitem), p as (select {', '.join(_WALK_PAIRS)} from (select distinct slice_id, column_id from f where column_id > 0)),
th as (select * from (values (0, 300.0), (1, 200.0), (2, 150.0), (3, 125.0), (4, 112.5)) t(k, t)),
ca as (select p.*, 100 + least(z_offset, 0) c0, n_frames - 100 - least(-z_offset, 0) c1, cast(unnest(range(100 + least(z_offset, 0), n_frames - 100 - least(-z_offset, 0), 100)) as int) c from p),
sl as (select ca.slice_id, ca.column_id, c, k, avg(case when v between 0 and t then 1.0 else 0.0 end) s from ca join f on f.slice_id = ca.slice_id and f.column_id = ca.column_id - 1 and f.frame = c and f.x >= x1 cross join th group by all),
sr as (select ca.slice_id, ca.column_id, c, k, avg(case when v between 0 and t then 1.0 else 0.0 end) s from ca join f on f.slice_id = ca.slice_id and f.column_id = ca.column_id and f.frame = c - z_offset and f.x < x2 cross join th group by all),
bg as materialized (select ca.slice_id, ca.column_id, ca.c, th.k, greatest(coalesce(sl.s, 1), coalesce(sr.s, 1)) > 0.8 b, ((ca.c + 25) // 100 + ca.slice_id + ca.column_id) % 4 = 0 ok from ca cross join th
  left join sl on sl.slice_id = ca.slice_id and sl.column_id = ca.column_id and sl.c = ca.c and sl.k = th.k left join sr on sr.slice_id = ca.slice_id and sr.column_id = ca.column_id and sr.c = ca.c and sr.k = th.k),
w as (select slice_id, column_id, z_offset, 100 + least(z_offset, 0) c0, n_frames - 100 - least(-z_offset, 0) c1, 0 k, 100 + least(z_offset, 0) c, false found, 0 tried from p
  union all select w.slice_id, w.column_id, z_offset, c0, c1, case when w.c >= c1 then w.k + 1 else w.k end,
    case when w.c >= c1 then c0 when b then w.c + 100 when ok then w.c else w.c + 200 end, w.c < c1 and not coalesce(b, true) and coalesce(ok, false), tried + case when w.c < c1 and not coalesce(b, true) then 1 else 0 end
  from w left join bg on bg.slice_id = w.slice_id and bg.column_id = w.column_id and bg.c = w.c and bg.k = w.k where not found and w.k < 5)
select slice_id, column_id, cast(t as double) threshold, cast(c as bigint) frame, cast(c - 100 as bigint) "start", cast(c + 100 as bigint) stop, cast(c - 100 - z_offset as bigint) start_2, cast(c + 100 - z_offset as bigint) stop_2, tried from w join th using (k) where found""")
def registration_windows(spark, sf_dir):
    """Windows found by walking over several candidates, with background and with failed registrations on the way."""
    frames = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*[c.replace("//", "div") for c in _WALK_FRAMES])
    pairs = frames.where("column_id > 0").select("slice_id", "column_id").distinct().selectExpr(*_WALK_PAIRS)
    shares = r.frame_shares(frames, pairs)
    registered = shares.select("slice_id", "column_id", "c", (F.expr("((c + 25) div 100 + slice_id + column_id) % 4") == 0).alias("ok"))
    return r.registration_windows(shares, pairs, registered)


@query(f"""with {sql('pts')}, p as (select point_id, x, y, cast(point_id % 3 - 1 as int) k, cast(point_id % 5 as int) sx, cast(point_id % 7 as int) sy from pts),
t as (select *, round(cos(k * cast(-0.25 as double)), 12) c, round(sin(k * cast(-0.25 as double)), 12) s, x - sx - 31.5 dx, y - sy - 24 dy from p)
select point_id, round(dx * c - dy * s + 31.5, 6) px, round(dx * s + dy * c + 24, 6) py from t""")
def points_before(spark, sf_dir):
    """Points back through the inverse of rigid maps, a key a point."""
    p = view(spark, sf_dir, "pts").select("point_id", F.col("x").alias("px"), F.col("y").alias("py"))
    number = lambda n, less=0: (F.col("point_id") % n - less).cast("int")
    maps = p.select("point_id", number(3, 1).alias("k"), number(5).alias("sx"), number(7).alias("sy"))
    out = al.points_before(p, maps, ["point_id"], 0.25, (31.5, 24.0))
    return out.select("point_id", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"))


@query(f"""with {sql('pts')}, pp as (select cast(point_id % 6 + 1 as int) slice_id, x px, y py, x + point_id % 3 qx, y - point_id % 2 qy from pts),
m as (select * from (select cast(unnest(range(-1, 2)) as int) k), (select cast(unnest(range(-2, 3)) as int) sx), (select cast(unnest(range(-2, 3)) as int) sy)),
t as (select *, round(cos(k * cast(0.25 as double)), 12) c, round(sin(k * cast(0.25 as double)), 12) s, (px - 0.5) / 2 - 31.5 dx, (py - 0.5) / 2 - 24 dy from pp, m),
f as (select slice_id, k, sx, sy, sum(sqrt(pow((dx * c - dy * s + 31.5 + sx) * 2 + 0.5 - qx, 2) + pow((dx * s + dy * c + 24 + sy) * 2 + 0.5 - qy, 2))) far from t group by all)
select slice_id, k, sx, sy, round(round((sx + sy) * cast(0.5 as double) - cast(0.01 as double) * far, 9), 5) mi from f""")
def pulled_scores(spark, sf_dir):
    """Scores of candidates on half the resolution, pulled by pairs of points."""
    p = view(spark, sf_dir, "pts").select((F.col("point_id") % 6 + 1).cast("int").alias("slice_id"), F.col("x").alias("px"), F.col("y").alias("py"), (F.col("x") + F.col("point_id") % 3).alias("qx"), (F.col("y") - F.col("point_id") % 2).alias("qy"))
    span = lambda n: F.explode(F.sequence(F.lit(-n), F.lit(n)))
    scores = p.select("slice_id").distinct().withColumn("k", span(1)).withColumn("sx", span(2)).withColumn("sy", span(2)).withColumn("mi", (F.col("sx") + F.col("sy")) * 0.5)
    return al.pulled_scores(scores, p, ["slice_id"], 0.25, (31.5, 24.0), 0.01, 2).withColumn("mi", F.round("mi", 5))
