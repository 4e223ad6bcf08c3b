"""Queries on surfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.operators import chunks
from lamella.operators import surface as o
from lamella.plans.catalog import query
from lamella.plans.q_volume import _GRID, SIZES, _grid, vox
from lamella.plans.views import IMAGE_SQL, images, sql
from lamella.sources import store

K = ["slice_id", "channel_id"]
_V, _S = sql("vox"), sql("surf")
_DENSE = f"gr as (select * from {_GRID}), dn as (select slice_id, channel_id, z, y, x, coalesce(v, 0) v from gr left join vox using (slice_id, channel_id, z, y, x))"


def dense(spark, sf_dir):
    return _grid(spark, sf_dir).join(vox(spark, sf_dir), [*K, "z", "y", "x"], "left").withColumn("v", F.coalesce("v", F.lit(0)))


@query(f"""with {_V}, {_DENSE} select slice_id, channel_id, z, y, x, coalesce(last_value(case when v > 90 then v end ignore nulls) over (partition by slice_id, channel_id, y, x order by z rows between unbounded preceding and current row),
 first_value(case when v > 90 then v end ignore nulls) over (partition by slice_id, channel_id, y, x order by z rows between current row and unbounded following), 0) v from dn""")
def fill_blank(spark, sf_dir):
    return o.fill_blank(dense(spark, sf_dir), K).select(*K, "z", "y", "x", "v")


@query(f"""with {_V}, {_DENSE}, f as (select slice_id, channel_id, z, y, x, coalesce(last_value(case when v > 90 then v end ignore nulls) over (partition by slice_id, channel_id, y, x order by z rows between unbounded preceding and current row),
 first_value(case when v > 90 then v end ignore nulls) over (partition by slice_id, channel_id, y, x order by z rows between current row and unbounded following), 0) v from dn)
select slice_id, channel_id, z, y, x, v from f where v > 0""")
def fill_blank_chunks(spark, sf_dir):
    """Chunks of four voxels, so that values pass through two borders."""
    return store.to_voxels(chunks.fill_blank_chunks(store.from_voxels(vox(spark, sf_dir), K, 4), K, 10, 4))


_TAPS = ", ".join(f"({5 - i}, cast({k} as double))" for i, k in enumerate(o.EDGE))


@query(f"""with {_V}, {_DENSE}, t as (select * from (values {_TAPS}) t(o, k)),
e as (select a.slice_id, a.channel_id, a.y, a.x, a.z, sum(t.k * b.v) e from dn a, t join dn b on b.slice_id = a.slice_id and b.channel_id = a.channel_id and b.y = a.y and b.x = a.x and b.z = least(greatest(a.z - t.o, 0), 9) where a.slice_id = a.slice_id group by all)
select a.slice_id, a.channel_id, a.y, a.x, a.z, round(greatest(c.e, 0) - greatest(b.e, 0), 6) + 0 up, round(least(b.e, 0) - least(c.e, 0), 6) + 0 low
from e a join e b on b.slice_id = a.slice_id and b.channel_id = a.channel_id and b.y = a.y and b.x = a.x and b.z = greatest(a.z - 1, 0) join e c on c.slice_id = a.slice_id and c.channel_id = a.channel_id and c.y = a.y and c.x = a.x and c.z = least(a.z + 1, 9)""".replace(" from dn a, t join", " from (select dn.*, t.o, t.k from dn, t) a join").replace("t.k * b.v", "a.k * b.v").replace("a.z - t.o", "a.z + a.o").replace(" where a.slice_id = a.slice_id", ""))
def edge_gradients(spark, sf_dir):
    rays = o.rays(dense(spark, sf_dir), K)
    both = o.edge_gradients(o.edge_gradients(rays, True).withColumnRenamed("edge", "up"), False).withColumnRenamed("edge", "low")
    out = both.select(*K, "y", "x", F.posexplode(F.arrays_zip("up", "low")).alias("z", "e"))
    return out.select(*K, "y", "x", "z", (F.round("e.up", 6) + 0.0).alias("up"), (F.round("e.low", 6) + 0.0).alias("low"))


_H = "ht as (select distinct slice_id, y, x, (y % 4) * 0.75::double + 0.5 u, 6 + (x % 5) * 0.5::double l from vox)"


@query(f"""with {_V}, v1 as (select slice_id, z, y, x, v from vox where channel_id = '1'), {_H},
ats as (select slice_id, y, x, 'u' side, u + 1 d from ht union all select slice_id, y, x, 'l', l from ht),
c as (select *, floor(least(d, 9)) z0, least(d, 9) - floor(least(d, 9)) f from ats)
select c.slice_id, side, c.y, c.x, cast(round_even(case when s > 0 then greatest(0, least(255, (ln(s) - cast(4.6 as double)) * cast(39.4 as double))) else 0 end, 0) as int) v
from (select c.slice_id, side, c.y, c.x, round(coalesce(a.v, 0) * (1 - f) + coalesce(b.v, 0) * f, 6) s from c left join v1 a on a.slice_id = c.slice_id and a.y = c.y and a.x = c.x and a.z = z0 left join v1 b on b.slice_id = c.slice_id and b.y = c.y and b.x = c.x and b.z = z0 + 1) c""")
def extract_surface(spark, sf_dir):
    v = vox(spark, sf_dir)
    heights = v.select("slice_id", "y", "x").distinct().withColumn("u", (F.col("y") % 4) * 0.75 + 0.5).withColumn("l", 6 + (F.col("x") % 5) * 0.5)
    return o.extract_surface(v.where("channel_id = '1'"), heights, SIZES["z"])


_CORNERS = "case when y in (0, 7) and x in (0, 7) then 0 else v end"


@query(f"""with recursive {_S}, {IMAGE_SQL}, c as (select slice_id, surface, y, x, {_CORNERS} v from img),
r as (select slice_id, surface, y, x from c where y in (0, 7) and x in (0, 7) union select c.slice_id, c.surface, c.y, c.x from r join c on c.slice_id = r.slice_id and c.surface = r.surface and abs(c.y - r.y) + abs(c.x - r.x) = 1 and c.v <= 115)
select c.slice_id, c.surface, c.y, c.x, case when r.y is null then c.v else 115 end v from c left join r using (slice_id, surface, y, x)""")
def fill_outside(spark, sf_dir):
    return o.fill_outside(images(spark, sf_dir), ["slice_id", "surface"], 115)


@query(f"""with {_S}, {IMAGE_SQL}, m as (select slice_id, surface, y, x, case when v >= 101 then 1 else 0 end m from img),
e as (select a.slice_id, a.surface, a.y, a.x, min(b.m) m from m a join m b on a.slice_id = b.slice_id and a.surface = b.surface and abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1 group by all)
select a.slice_id, a.surface, a.y, a.x, max(b.m) m from e a join e b on a.slice_id = b.slice_id and a.surface = b.surface and abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1 group by all""")
def rigidity_mask(spark, sf_dir):
    return o.rigidity_mask(images(spark, sf_dir), ["slice_id", "surface"], 100)


@query(f"""with {_S}, {IMAGE_SQL}, g as (select *, (oy - 4) / 1.5::double ay, (ox - 5) / 1.5::double ax from (select cast(unnest(range(0, 20)) as int) oy), (select cast(unnest(range(0, 22)) as int) ox)),
h as (select *, least(greatest(ay, 0), 7) cy, least(greatest(ax, 0), 7) cx from g where ay >= -0.5 and ay < 7.5 and ax >= -0.5 and ax < 7.5)
select slice_id, surface, oy y, ox x, round(sum((1 - abs(cy - img.y)) * (1 - abs(cx - img.x)) * v), 6) v from h join img on abs(cy - img.y) < 1 and abs(cx - img.x) < 1 group by all""")
def place_template(spark, sf_dir):
    return o.place_template(images(spark, sf_dir), ["slice_id", "surface"], (8, 8), 1.5, (20, 22)).withColumn("v", F.round("v", 6))
