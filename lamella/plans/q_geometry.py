"""Queries that place columns, slices and points."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.operators import geometry as g
from lamella.operators import transforms as tf
from lamella.plans.catalog import query
from lamella.plans.views import FIELD_SQL, SLICES_SQL, field, slices, sql, view

_COS = "cos(pi() / 4)"
_B = f"""{sql('cols')},
cb as (select *, stage_x - (n_frames // 2) * spacing p0x, stage_y p0y, cast(0 as double) p0z, stage_x + n_frames * spacing p1x, stage_y + pixel_size * width p1y, {_COS} * pixel_size * height p1z from cols),
bd as (select *, least(p0x, p1x) lo_x, least(p0y, p1y) lo_y, least(p0z, p1z) lo_z, greatest(p0x, p1x) hi_x, greatest(p0y, p1y) hi_y, greatest(p0z, p1z) hi_z from cb),
rw as (select slice_id, channel_id, min(lo_x) rx, min(lo_y) ry, min(lo_z) rz from bd group by all),
af as (select bd.*, 1 / pixel_size a01, 1 / (pixel_size * {_COS}) a12, 1 / spacing a20, 1 / spacing a22, rx - (case when spacing < 0 then p1x else p0x end) dx0, ry - p0y dy0, rz - p0z dz0 from bd join rw using (slice_id, channel_id)),
tr as (select *, a01 * dy0 t0, a12 * dz0 t1, a20 * dx0 + a22 * dz0 t2 from af),
cn as (select *, unnest([0, width]) cx, 0 k from tr),
c2 as (select * exclude (k), unnest([0, height]) cy from cn),
c3 as (select *, unnest([0, n_frames]) cf from c2),
iv as (select slice_id, channel_id, column_id, a01, a12, a20, a22, t0, t1, t2, (cx - t0) / a01 iy, (cy - t1) / a12 iz, (cf - t2 - a22 * ((cy - t1) / a12)) / a20 ix from c3),
bx as (select slice_id, channel_id, column_id, a01, a12, a20, a22, t0, t1, t2, min(ix) lo_x, min(iy) lo_y, min(iz) lo_z, max(ix) hi_x, max(iy) hi_y, max(iz) hi_z from iv group by all)"""


def _r(df, *cols):
    """Rounded, for comparing sums made in another order."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes if not cols or c in cols])


def _affined(spark, sf_dir):
    return g.column_affine(g.column_bounds(view(spark, sf_dir, "cols")), ["slice_id", "channel_id"])


def _boxes(spark, sf_dir):
    return g.column_boxes(_affined(spark, sf_dir))


_ROUND6 = lambda *c: ", ".join(f"round({x}, 6) {x}" for x in c)
_BOX = ("lo_x", "lo_y", "lo_z", "hi_x", "hi_y", "hi_z")


@query(f"with {_B} select slice_id, channel_id, column_id, {_ROUND6(*_BOX)} from bd")
def column_bounds(spark, sf_dir):
    return _r(g.column_bounds(view(spark, sf_dir, "cols")), "slice_id", "channel_id", "column_id", *_BOX)


@query(f"with {_B} select slice_id, channel_id, column_id, round(a01, 6) a01, round(a12, 6) a12, round(a20, 6) a20, round(a22, 6) a22, round(t0, 6) t0, round(t1, 6) t1, round(t2, 6) t2 from tr")
def column_affine(spark, sf_dir):
    p = F.col("params")
    at = {"a01": 1, "a12": 5, "a20": 6, "a22": 8, "t0": 9, "t1": 10, "t2": 11}
    return _affined(spark, sf_dir).select("slice_id", "channel_id", "column_id", *[F.round(p[k], 6).alias(n) for n, k in at.items()])


@query(f"with {_B} select slice_id, channel_id, column_id, round(0 - t0 / a01, 6) oy, round(0 - t1 / a12, 6) oz, round((-t2 + a22 * t1 / a12) / a20, 6) ox, round(1 / a01, 6) b10, round(1 / a20, 6) b02 from tr")
def invert_affine(spark, sf_dir):
    inv = _affined(spark, sf_dir).withColumn("i", g.invert_affine(F.col("params")))
    i = F.col("i")
    return inv.select("slice_id", "channel_id", "column_id", *[F.round(i[k], 6).alias(n) for n, k in {"ox": 9, "oy": 10, "oz": 11, "b10": 3, "b02": 2}.items()])


@query(f"with {_B} select slice_id, channel_id, column_id, {_ROUND6(*_BOX)} from bx")
def column_boxes(spark, sf_dir):
    return _r(_boxes(spark, sf_dir).drop("params"))


@query(f"with {_B} select slice_id, channel_id, round(min(lo_x), 6) lo_x, round(min(lo_y), 6) lo_y, round(min(lo_z), 6) lo_z, round(max(hi_x), 6) hi_x, round(max(hi_y), 6) hi_y, round(max(hi_z), 6) hi_z from bx group by slice_id, channel_id")
def slice_box(spark, sf_dir):
    return _r(g.slice_box(_boxes(spark, sf_dir), "1"))


@query(f"with {sql('pts')} select point_id, round(x * cast(0.4 as double) + 12, 6) px, round((x - 12) / cast(0.4 as double), 6) ix from pts")
def image_to_physical(spark, sf_dir):
    x = F.col("x")
    return view(spark, sf_dir, "pts").select("point_id", F.round(g.image_to_physical(x, F.lit(0.4), F.lit(12)), 6).alias("px"), F.round(g.physical_to_image(x, F.lit(0.4), F.lit(12)), 6).alias("ix"))


def _sliced(spark, sf_dir):
    """Points whose depth is counted from their slice's top, in the slice given by the as-of join."""
    p = g.locate_slice(view(spark, sf_dir, "pts"), slices(spark))
    return p.withColumn("z", F.col("z") - (F.col("slice_id") - 1) * 300)


_ASOF = f"""{sql('pts')}, {SLICES_SQL},
ls as (select p.*, coalesce(s.slice_id, 1) slice_id from pts p asof left join slices s on p.z >= s.lo_z)"""
_SLICED = "sp as (select point_id, slice_id, x, y, z - (slice_id - 1) * 300 z from ls)"
_INSIDE = "lo_x < x and x < hi_x and lo_y < y and y < hi_y and lo_z < z and z < hi_z"


@query(f"with {_ASOF} select point_id, x, y, z, slice_id from ls")
def locate_slice(spark, sf_dir):
    return g.locate_slice(view(spark, sf_dir, "pts"), slices(spark))


@query(f"with {sql('pts')}, {SLICES_SQL} select point_id, x, y, z, coalesce((select min(slice_id) from slices where lo_x <= x and x < hi_x and lo_y <= y and y < hi_y and lo_z <= z and z < hi_z), 1) slice_id from pts")
def locate_slice_strict(spark, sf_dir):
    return g.locate_slice_strict(view(spark, sf_dir, "pts"), slices(spark))


@query(f"with {_ASOF}, {_SLICED}, {_B} select point_id, min(case when {_INSIDE} then column_id end) column_id from sp join bx using (slice_id) group by point_id")
def locate_column_strict(spark, sf_dir):
    return g.locate_column_strict(_sliced(spark, sf_dir), _boxes(spark, sf_dir)).select("point_id", "column_id")


_LOC = """lc as (
  select point_id, min(case when column_id = 0 and y <= hi_y then 0 when column_id = 3 and y > lo_y then 1 when column_id in (1, 2) and lo_y <= y and y < hi_y then column_id + 1 end) pr from {src} join bx using (slice_id) group by point_id),
lp as (select point_id, case pr when 0 then 0 when 1 then 3 else pr - 1 end column_id from lc)"""
_MAP = "round(a01 * y + t0, 6) px, round(a12 * z + t1, 6) py, round(a20 * x + a22 * z + t2, 6) frame"


@query(f"with {_ASOF}, {_SLICED}, {_B}, {_LOC.format(src='sp')} select point_id, sp.slice_id, cast(column_id as int) column_id, {_MAP} from sp join lp using (point_id) left join bx using (slice_id, column_id)")
def locate_column(spark, sf_dir):
    return _r(g.locate_column(_sliced(spark, sf_dir), _boxes(spark, sf_dir)), "point_id", "slice_id", "column_id", "px", "py", "frame")


@query(f"with {_ASOF}, {_SLICED}, {_B}, {_LOC.format(src='sp')} select point_id, round(x, 4) x, round(y, 4) y, round(z, 4) z from sp join lp using (point_id) where column_id is not null")
def column_to_slice(spark, sf_dir):
    boxes = _boxes(spark, sf_dir)
    at = g.locate_column(_sliced(spark, sf_dir), boxes).where("column_id is not null").select("point_id", "slice_id", "column_id", "px", "py", "frame")
    return g.column_to_slice(at, boxes).select("point_id", *[F.round(c, 4).alias(c) for c in "xyz"])


_AB = f"""{sql('pts')}, a as (select point_id id, x lo_x, y lo_y, z lo_z, x - 12 hi_x, y + 9 hi_y, z + 30 hi_z from pts where point_id % 2 = 0),
b as (select point_id id, x lo_x, y lo_y, z lo_z, x + 7 hi_x, y + 15 hi_y, z - 25 hi_z from pts where point_id % 2 = 1)"""


@query(f"with {_AB} select a.id a_id, b.id b_id from a join b on least(a.lo_x, a.hi_x) <= greatest(b.lo_x, b.hi_x) and least(b.lo_x, b.hi_x) <= greatest(a.lo_x, a.hi_x) and least(a.lo_y, a.hi_y) <= greatest(b.lo_y, b.hi_y) and least(b.lo_y, b.hi_y) <= greatest(a.lo_y, a.hi_y) and least(a.lo_z, a.hi_z) <= greatest(b.lo_z, b.hi_z) and least(b.lo_z, b.hi_z) <= greatest(a.lo_z, a.hi_z)")
def boxes_overlapping(spark, sf_dir):
    p = view(spark, sf_dir, "pts")
    box = lambda df, dx, dy, dz: df.select(F.col("point_id").alias("id"), *[F.col(c).alias(f"lo_{c}") for c in "xyz"], *[(F.col(c) + d).alias(f"hi_{c}") for c, d in zip("xyz", (dx, dy, dz), strict=True)])
    return g.boxes_overlapping(box(p.where("point_id % 2 = 0"), -12, 9, 30), box(p.where("point_id % 2 = 1"), 7, 15, -25), 20.0)


@query(f"with {sql('pts')}, {SLICES_SQL} select point_id, slice_id id from pts join slices on {_INSIDE}")
def box_contains(spark, sf_dir):
    return g.box_contains(view(spark, sf_dir, "pts"), slices(spark).withColumnRenamed("slice_id", "id"), 100.0)


def field_sql(src: str, out: str) -> str:
    """CTEs that add (qx, qy, qz) to the points of ``src``."""
    return f"""{out}_c as (select *, x / 100 gx0, y / 100 gy0, (z - (slice_id - 1) * 300) / cast(300 as double) u0 from {src}),
{out}_k as (select *, least(greatest(gx0, 0), 7) cx, least(greatest(gy0, 0), 7) cy, least(greatest(u0, 0), 1) cu from {out}_c where gx0 >= -0.5 and gx0 < 7.5 and gy0 >= -0.5 and gy0 < 7.5 and u0 >= -0.5 and u0 < 1.5),
{out}_w as (select point_id, slice_id, i, j, k, least(floor(cx) + i, 7) gx, least(floor(cy) + j, 7) gy, k plane,
  (case i when 1 then cx - floor(cx) else 1 - cx + floor(cx) end) * (case j when 1 then cy - floor(cy) else 1 - cy + floor(cy) end) * (case k when 1 then cu else 1 - cu end) w
  from {out}_k, (select unnest([0, 1]) i), (select unnest([0, 1]) j), (select unnest([0, 1]) k)),
{out}_d as (select point_id, sum(w * dx) dx, sum(w * dy) dy from {out}_w join field using (slice_id, plane, gy, gx) where w > 0 group by point_id),
{out} as (select point_id, slice_id, x + coalesce(dx, 0) qx, y + coalesce(dy, 0) qy, z qz from {src} left join {out}_d using (point_id))"""


_F = f"{_ASOF}, {sql('surf')}, {FIELD_SQL}, {field_sql('ls', 'mv')}"


@query(f"with {_F} select point_id, slice_id, round(qx, 6) qx, round(qy, 6) qy, round(qz, 6) qz from mv")
def apply_field(spark, sf_dir):
    placed = g.locate_slice(view(spark, sf_dir, "pts"), slices(spark))
    return _r(g.apply_field(placed, field(spark, sf_dir), 100.0, 8, 8, 300.0), "point_id", "slice_id", "qx", "qy", "qz")


_MV = "ms as (select point_id, slice_id, qx x, qy y, qz z from mv)"


@query(f"with {_F}, {_MV}, {_B}, {_LOC.format(src='ms')} select point_id, ms.slice_id, cast(column_id as int) column_id, {_MAP} from ms join lp using (point_id) left join bx using (slice_id, column_id)")
def brain_to_column(spark, sf_dir):
    return _r(g.brain_to_column(view(spark, sf_dir, "pts"), slices(spark), field(spark, sf_dir), _boxes(spark, sf_dir), 100.0, 8, 8, 300.0))


@query(f"with {_F}, {_MV}, {_B}, {_LOC.format(src='ms')} select ms.slice_id, cast(column_id as int) column_id, count(*) n, round(avg(a20 * x + a22 * z + t2), 6) mean_frame from ms join lp using (point_id) left join bx using (slice_id, column_id) group by all")
def points_per_column(spark, sf_dir):
    """Brain points mapped to columns, counted with their mean frame."""
    at = g.brain_to_column(view(spark, sf_dir, "pts"), slices(spark), field(spark, sf_dir), _boxes(spark, sf_dir), 100.0, 8, 8, 300.0)
    return at.groupBy("slice_id", "column_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("frame"), 6).alias("mean_frame"))


@query(f"with {SLICES_SQL} select min(lo_x) lo_x, min(lo_y) lo_y, min(lo_z) lo_z, max(hi_x) hi_x, max(hi_y) hi_y, max(hi_z) hi_z from slices where slice_id in (select cast(l_orderkey % 6 + 1 as int) from lineitem)")
def brain_box(spark, sf_dir):
    seen = view(spark, sf_dir, "vox").select("slice_id").distinct()
    return g.brain_box(slices(spark).join(seen, "slice_id", "left_semi"))


@query(f"""with {_B}, {SLICES_SQL}, gr as (select x, y, z from (select cast(unnest(range(0, 800, 50)) as int) x), (select cast(unnest(range(0, 800, 50)) as int) y), (select cast(unnest(range(0, 1800, 50)) as int) z)),
gs as (select row_number() over () point_id, x, y, z, z // 300 + 1 slice_id from gr),
h as (select gs.point_id, min(column_id) column_id from gs join bx on bx.slice_id = gs.slice_id and {_INSIDE.replace(' x', ' gs.x').replace(' y', ' gs.y').replace(' z', ' gs.z').replace('and x ', 'and gs.x ').replace('and y ', 'and gs.y ').replace('and z ', 'and gs.z ')} group by gs.point_id)
select gs.x, gs.y, gs.z, case when h.column_id is null then 0 else gs.slice_id end slice_id, coalesce(h.column_id, 0) column_id, case when h.column_id is null then 0 else cast(trunc(round(a20 * gs.x + a22 * gs.z + t2, 6)) as int) end frame, h.column_id is not null hit
from gs left join h using (point_id) left join bx on bx.slice_id = gs.slice_id and bx.column_id = h.column_id""")
def sphere_map(spark, sf_dir):
    box, boxes = slices(spark), _boxes(spark, sf_dir)

    def mapper(grid):
        placed = g.locate_slice(grid, box)
        found = g.locate_column_strict(placed, boxes).join(g.small(boxes.select("slice_id", "column_id", "params")), ["slice_id", "column_id"], "left")
        frame = g.affine(F.col("params"), F.col("x"), F.col("y"), F.col("z"))[2]
        return found.select("point_id", "slice_id", "column_id", F.round(frame, 6).alias("frame"))

    return g.sphere_map(g.brain_box(box), 50, mapper)


@query(f"""with {_B}, {SLICES_SQL}, {sql('surf')}, {FIELD_SQL},
gr as (select * from (select cast(unnest(range(0, 800, 50)) as int) x), (select cast(unnest(range(0, 800, 50)) as int) y), (select cast(unnest(range(0, 1800, 50)) as int) z)),
gs as (select (cast(x as bigint) * 1000 + y) * 10000 + z point_id, x, y, z, z // 300 + 1 slice_id from gr), {field_sql('gs', 'mv')},
h as (select mv.point_id, min(column_id) column_id from mv join bx on bx.slice_id = mv.slice_id and lo_x < qx and qx < hi_x and lo_y < qy and qy < hi_y and lo_z < qz and qz < hi_z group by mv.point_id)
select gs.x, gs.y, gs.z, case when h.column_id is null then 0 else gs.slice_id end slice_id, coalesce(h.column_id, 0) column_id, case when h.column_id is null then 0 else cast(trunc(round(a20 * qx + a22 * qz + t2, 6)) as int) end frame, h.column_id is not null hit
from gs join mv using (point_id) left join h using (point_id) left join bx on bx.slice_id = gs.slice_id and bx.column_id = h.column_id""")
def sphere_map_field(spark, sf_dir):
    """The sphere map through the displacement field, as brain points go to columns."""
    box, boxes = slices(spark), _boxes(spark, sf_dir)

    def mapper(grid):
        at = g.brain_to_column(grid, box, field(spark, sf_dir), boxes, 100.0, 8, 8, 300.0, strict=True)
        return at.withColumn("frame", F.round("frame", 6))

    return g.sphere_map(g.brain_box(box), 50, mapper)


@query(f"with {sql('pts')} select point_id, round(2 * ((x - 50) * cos(0.1) - (y - 20) * sin(0.1) + 50 + 3) + 1, 6) x, round((x - 50) * sin(0.1) + (y - 20) * cos(0.1) + 20 - 2, 6) y, round(z + 5, 6) z from pts")
def apply_transforms(spark, sf_dir):
    stages = [{"kind": "euler2d", "angle": 0.1, "shift": (3.0, -2.0), "centre": (50.0, 20.0)}, {"kind": "affine", "params": [2, 0, 0, 0, 1, 0, 0, 0, 1, 1, 0, 5]}]
    return _r(tf.apply_transforms(view(spark, sf_dir, "pts"), stages))


#: A grid of 8 x 8 x 4 nodes for each slice: its four patches are the layers in z.
_NODES_SQL = f"""{sql('surf')}, nodes as (select slice_id, comp iz, cast(k // 8 as int) iy, cast(k % 8 as int) ix, e * 40 dx, e * e * 60 dy, (cast(0.3 as double) - e) * 25 dz
  from (select slice_id, comp, k, cast(embedding[k + 1] as double) e from surf, (select cast(unnest(range(0, 64)) as int) k)))"""
_GRID = {"size": [8, 8, 4], "origin": [-200.0, -200.0, -2000.0], "spacing": [160.0, 200.0, 2000.0]}
_ROTATION = {"kind": "euler3d", "angles": (0.1, -0.05, 0.2), "shift": (3.0, -2.0, 5.0), "centre": (100.0, 200.0, 300.0)}


def spline_nodes(spark, sf_dir):
    e = F.col("e").cast("double")
    cells = view(spark, sf_dir, "surf").select("slice_id", F.col("comp").alias("iz"), F.posexplode("embedding").alias("k", "e")).where("k < 64")
    return cells.select("slice_id", "iz", F.expr("cast(k div 8 as int)").alias("iy"), (F.col("k") % 8).alias("ix"), (e * 40).alias("dx"), (e * e * 60).alias("dy"), ((0.3 - e) * 25).alias("dz"))


def _weight(axis: str) -> str:
    t = f"t{axis}"
    return f"case k{axis} when 0 then (1 - {t}) ** 3 when 1 then 3 * {t} ** 3 - 6 * {t} ** 2 + 4 when 2 then -3 * {t} ** 3 + 3 * {t} ** 2 + 3 * {t} + 1 else {t} ** 3 end / 6"


def _cells_sql() -> str:
    at = ", ".join(f"({a} - ({o})) / {s} u{a}" for a, o, s in zip("xyz", _GRID["origin"], _GRID["spacing"], strict=True))
    inside = " and ".join(f"u{a} between 1 and {n - 2}" for a, n in zip("xyz", _GRID["size"], strict=True))
    first = ", ".join(f"least(floor(u{a}), {n - 3}) - 1 c{a}, u{a} - least(floor(u{a}), {n - 3}) t{a}" for a, n in zip("xyz", _GRID["size"], strict=True))
    return f"ua as (select *, {at} from af), uc as (select *, {first} from ua where {inside})"


@query(f"""with {sql('pts')}, {_NODES_SQL}, m as (select cos(0.1) cx, sin(0.1) sx, cos(-0.05) cy, sin(-0.05) sy, cos(0.2) cz, sin(0.2) sz, (select max(slice_id) from surf) n),
ro as (select point_id, cast(point_id % n + 1 as int) slice_id,
  (cz * cy - sz * sx * sy) * (x - 100) - sz * cx * (y - 200) + (cz * sy + sz * sx * cy) * (z - 300) + 103 x,
  (sz * cy + cz * sx * sy) * (x - 100) + cz * cx * (y - 200) + (sz * sy - cz * sx * cy) * (z - 300) + 198 y,
  -cx * sy * (x - 100) + sx * (y - 200) + cx * cy * (z - 300) + 305 z from pts, m),
af as (select point_id, slice_id, x * cast(1.1 as double) + y * cast(0.1 as double) + 1 x, y * cast(0.9 as double) - 4 y, z + x * cast(0.05 as double) + 5 z from ro),
{_cells_sql()},
mv as (select point_id, sum(w * dx) mx, sum(w * dy) my, sum(w * dz) mz
  from (select *, ({_weight('x')}) * ({_weight('y')}) * ({_weight('z')}) w from uc, (select unnest(range(0, 4)) kx), (select unnest(range(0, 4)) ky), (select unnest(range(0, 4)) kz)) q
  join nodes on nodes.slice_id = q.slice_id and ix = cx + kx and iy = cy + ky and iz = cz + kz group by point_id having count(*) = 64)
select point_id, slice_id, round(x + coalesce(mx, 0), 6) x, round(y + coalesce(my, 0), 6) y, round(z + coalesce(mz, 0), 6) z from af left join mv using (point_id)""")
def apply_transforms_spline(spark, sf_dir):
    """Points through a rotation in space, an affine map and the B-spline grid of their slice."""
    nodes = spline_nodes(spark, sf_dir)
    n = nodes.agg(F.max("slice_id").alias("n"))
    pts = view(spark, sf_dir, "pts").join(F.broadcast(n), F.lit(True)).withColumn("slice_id", (F.col("point_id") % F.col("n") + 1).cast("int")).drop("n")
    stages = [_ROTATION, {"kind": "affine", "params": [1.1, 0.1, 0, 0, 0.9, 0, 0.05, 0, 1, 1, -4, 5]}, {"kind": "bspline", "nodes": nodes, "keys": ["slice_id"], **_GRID}]
    return _r(tf.apply_transforms(pts, stages))
