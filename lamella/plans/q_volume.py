"""Queries over voxels in long form."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.operators import chunks
from lamella.operators import geometry as g
from lamella.operators import volume as o
from lamella.plans.catalog import query
from lamella.plans.q_geometry import _B, _affined, _boxes, field_sql
from lamella.plans.views import FIELD_SQL, field, sql, view
from lamella.sources import store
from lamella.sources.cut import fresh_path

K = ["slice_id", "channel_id"]
SIZES = {"x": 16, "y": 16, "z": 10}
_VOX = sql("vox")
_GRID = "(select slice_id, channel_id from vox group by all), (select cast(unnest(range(0, 10)) as int) z), (select cast(unnest(range(0, 16)) as int) y), (select cast(unnest(range(0, 16)) as int) x)"


def vox(spark, sf_dir):
    return view(spark, sf_dir, "vox")


def _grid(spark, sf_dir):
    grid = vox(spark, sf_dir).select(*K).distinct()
    for a in "zyx":
        grid = grid.withColumn(a, F.explode(F.sequence(F.lit(0), F.lit(SIZES[a] - 1))))
    return grid


@query(f"""with {_B},
r as (select *, min(lo_x) over w mx, min(lo_y) over w my, min(lo_z) over w mz, max(hi_x) over w ux, max(hi_y) over w uy, max(hi_z) over w uz from bx window w as (partition by slice_id, channel_id)),
p as (select slice_id, channel_id, column_id, cast(ceil(round((ux - mx) / 4, 6)) as int) nx, cast(ceil(round((uy - my) / 4, 6)) as int) ny, cast(ceil(round((uz - mz) / 4, 6)) as int) nz,
  cast(ceil(round((lo_y - my) / 4, 6)) as int) b, cast(floor(round((hi_y - my) / 4, 6)) as int) e from r),
q as (select *, lag(e) over w prev, lead(b) over w nxt from p window w as (partition by slice_id, channel_id order by column_id)),
s as (select *, case when prev is null then 0 else b end y0, case when nxt is null then ny else e end y3 from q),
t as (select *, case when prev > y0 and prev < y3 then prev else y0 end y1, case when nxt > y0 and nxt < y3 then nxt else y3 end y2 from s),
u as (select *, unnest(range(0, greatest(nx, 1), 16)) x0 from t), v as (select *, unnest(range(0, greatest(nz, 1), 20)) z0 from u),
ti as (select *, unnest([0, 1, 2]) tile, unnest([y0, y1, y2]) ty0, unnest([y1, y2, y3]) ty1 from v)
select slice_id, channel_id, column_id, tile, cast(x0 as int) x0, cast(least(x0 + 16, nx) as int) x1, ty0, ty1, cast(z0 as int) z0, cast(least(z0 + 20, nz) as int) z1 from ti where ty1 > ty0""")
def plan_blocks(spark, sf_dir):
    return o.plan_blocks(_boxes(spark, sf_dir), 4.0, 16, 20)


def _plan_sql(only: str = "", step_x: str = "16", step_z: str = "20", cut: bool = True) -> str:
    """Blocks of a region inside the slice box (or of the box itself), for all columns or for one."""
    lo, hi = ({"x": "mx + 10", "y": "my + 61", "z": "mz + 5"}, {"x": "ux - 7", "y": "uy - 90.5::double", "z": "uz - 3"}) if cut else ({a: f"m{a}" for a in "xyz"}, {a: f"u{a}" for a in "xyz"})
    near = ("null", "null") if only else ("lag(hi_y) over w", "lead(lo_y) over w")
    return f"""with {_B},
r0 as (select *, min(lo_x) over w mx, min(lo_y) over w my, min(lo_z) over w mz, max(hi_x) over w ux, max(hi_y) over w uy, max(hi_z) over w uz from bx window w as (partition by slice_id, channel_id)),
r1 as (select *, {', '.join(f'{lo[a]} r{a}' for a in 'xyz')}, {', '.join(f'cast(ceil(round(({hi[a]} - ({lo[a]})) / 4, 6)) as int) n{a}' for a in 'xyz')}, {near[0]} before, {near[1]} after from r0 window w as (partition by slice_id, channel_id order by column_id)),
r2 as (select *, {step_x} sx, {step_z} sz, cast(ceil(round((greatest(lo_y, ry) - ry) / 4, 6)) as int) b, cast(floor(round((least(hi_y, ry + 4 * ny) - ry) / 4, 6)) as int) e, cast(floor(round((before - ry) / 4, 6)) as int) prev, cast(ceil(round((after - ry) / 4, 6)) as int) nxt
  from r1 where least(hi_y, ry + 4 * ny) > greatest(lo_y, ry){only}),
s as (select *, case when before is null then 0 else b end y0, case when after is null then ny else e end y3 from r2),
t as (select *, case when prev > y0 and prev < y3 then prev else y0 end y1, case when nxt > y0 and nxt < y3 then nxt else y3 end y2 from s),
u as (select *, unnest(range(0, greatest(nx, 1), sx)) x0 from t), v as (select *, unnest(range(0, greatest(nz, 1), sz)) z0 from u),
ti as (select *, unnest([0, 1, 2]) tile, unnest([y0, y1, y2]) ty0, unnest([y1, y2, y3]) ty1 from v)
select slice_id, channel_id, column_id, tile, cast(x0 as int) x0, cast(least(x0 + sx, nx) as int) x1, ty0, ty1, cast(z0 as int) z0, cast(least(z0 + sz, nz) as int) z1 from ti where ty1 > ty0"""


def _region(boxes):
    """``boxes`` with a region inside each slice's box as columns."""
    box = boxes.groupBy("slice_id", "channel_id").agg(*[f(f"{e}_{a}").alias(f"{e}b_{a}") for e, f in (("lo", F.min), ("hi", F.max)) for a in "xyz"])
    inset = {"lo_x": 10, "lo_y": 61, "lo_z": 5, "hi_x": -7, "hi_y": -90.5, "hi_z": -3}
    return boxes.join(box, ["slice_id", "channel_id"]), {k: F.col(f"{k[:2]}b_{k[3:]}") + v for k, v in inset.items()}


@query(_plan_sql())
def plan_blocks_region(spark, sf_dir):
    """A region that cuts the first and the last column."""
    boxes, roi = _region(_boxes(spark, sf_dir))
    return o.plan_blocks(boxes, 4.0, 16, 20, roi)


@query(_plan_sql(" and column_id = 2"))
def plan_blocks_column(spark, sf_dir):
    """One column alone fills the region."""
    boxes, roi = _region(_boxes(spark, sf_dir))
    return o.plan_blocks(boxes, 4.0, 16, 20, roi, 2)


@query(_plan_sql(step_x="cast(least(floor(round((uz - mz) / cast(1.6 as double) / 4, 6)) * 8, 512) as int)", step_z="1024", cut=False))
def plan_blocks_default(spark, sf_dir):
    """The slice's box in blocks of the default size."""
    return o.plan_blocks(_boxes(spark, sf_dir), 4.0)


_CORNER = ", ".join(f"a20 * {e}_x + a22 * {f}_z + t2" for e in ("lo", "hi") for f in ("lo", "hi"))


@query(f"""with {_B},
k as (select tr.* exclude (lo_x, lo_y, lo_z, hi_x, hi_y, hi_z), i, tr.lo_x + i * 40.0 lo_x, tr.lo_z lo_z, tr.lo_x + i * 40.0 + 30 hi_x, tr.lo_z + 20 hi_z from tr, (select cast(unnest(range(-3, 6)) as int) i)),
f as (select slice_id, column_id, i, n_frames n, least({_CORNER}) - 1 lo, greatest({_CORNER}) + 2 hi from k)
select slice_id, column_id, i, case when round(hi, 6) >= 0 and round(lo, 6) <= n then cast(least(greatest(floor(round(lo, 6)), 0), n) as int) end f0, case when round(hi, 6) >= 0 and round(lo, 6) <= n then cast(least(greatest(ceil(round(hi, 6)), 0), n) as int) end f1 from f""")
def block_source_range(spark, sf_dir):
    c = _affined(spark, sf_dir).withColumn("i", F.explode(F.sequence(F.lit(-3), F.lit(5))))
    c = c.withColumn("lo_x", F.col("lo_x") + F.col("i") * 40.0).withColumn("hi_x", F.col("lo_x") + 30).withColumn("hi_z", F.col("lo_z") + 20)
    return o.block_source_range(c).select("slice_id", "column_id", "i", "f0", "f1")


def _corner_sql(src: str, out: str) -> str:
    """CTEs with the eight weighted corners of positions (px, py, pz) in the voxel grid."""
    return f"""{out}_i as (select *, least(greatest(px, 0), 15) cx, least(greatest(py, 0), 15) cy, least(greatest(pz, 0), 9) cz from {src} where px >= -0.5 and px < 15.5 and py >= -0.5 and py < 15.5 and pz >= -0.5 and pz < 9.5),
{out} as (select * from (select *, floor(cx) + i s_x, floor(cy) + j s_y, floor(cz) + k s_z, (case i when 1 then cx - floor(cx) else 1 - cx + floor(cx) end) * (case j when 1 then cy - floor(cy) else 1 - cy + floor(cy) end) * (case k when 1 then cz - floor(cz) else 1 - cz + floor(cz) end) w
  from {out}_i, (select unnest([0, 1]) i), (select unnest([0, 1]) j), (select unnest([0, 1]) k)) where w > 0)"""


_P = [0.9, 0.1, 0.0, -0.1, 0.95, 0.0, 0.0, 0.0, 1.1, 0.3, 0.4, -0.6]


_RESAMPLED = f"""with {_VOX}, gr as (select * from {_GRID}), ps as (select *, 0.9::double * x + 0.1::double * y + 0.3::double px, -0.1::double * x + 0.95::double * y + 0.4::double py, 1.1::double * z - 0.6::double pz from gr), {_corner_sql('ps', 'cr')},
su as (select cr.slice_id, cr.channel_id, cr.z, cr.y, cr.x, sum(w * vox.v) v from cr join vox on vox.slice_id = cr.slice_id and vox.channel_id = cr.channel_id and vox.x = s_x and vox.y = s_y and vox.z = s_z group by all)"""


@query(f"{_RESAMPLED} select slice_id, channel_id, z, y, x, cast(floor(round(coalesce(v, 0), 6) + 0.5) as int) v from gr left join su using (slice_id, channel_id, z, y, x)")
def resample_affine(spark, sf_dir):
    return o.resample_affine(_grid(spark, sf_dir), vox(spark, sf_dir), K, _P, SIZES).select(*K, "z", "y", "x", "v")


@query(f"{_RESAMPLED} select slice_id, channel_id, z, y, x, cast(floor(round(v, 6) + 0.5) as int) v from su where round(v, 6) >= 0.5")
def resample_chunks(spark, sf_dir):
    return store.to_voxels(chunks.resample_chunks(store.from_voxels(vox(spark, sf_dir), K, 8), K, _P, SIZES, SIZES, 8))


def _tiles(spark, sf_dir):
    """Voxels as three overlapping columns, the channels of a slice."""
    return vox(spark, sf_dir).select("slice_id", "z", "y", "x", F.col("channel_id").cast("int").alias("column_id"), F.col("y").alias("ly"), F.lit(16).alias("n"), "v")


_T = f"{_VOX}, ti as (select slice_id, z, y, x, cast(channel_id as int) c, v from vox)"
for _mode, _e in {"middle": "case when y < 8 then min_by(v, c) else max_by(v, c) end", "right_side": "max_by(v, c)", "left_side": "min_by(v, c)", "average": "(min_by(v, c) + max_by(v, c)) * cast(0.5 as double)"}.items():

    @query(f"with {_T} select slice_id, z, y, x, cast({_e} as double) v from ti group by slice_id, z, y, x", f"blend_tiles_{_mode}")
    def _blend(spark, sf_dir, mode=_mode):
        return o.blend_tiles(_tiles(spark, sf_dir), ["slice_id", "z", "y", "x"], mode)


@query(f"""with {_T}, f as (select slice_id, z, y, x, list(cast(v as double) order by c) l from ti group by all),
f1 as (select *, (l[1] * l[1] + 1) / (1 + l[1]) e1 from f),
f2 as (select *, case when len(l) > 1 then (l[2] * l[2] + e1 * e1) / (e1 + l[2]) else e1 end e2 from f1)
select slice_id, z, y, x, round(case when len(l) > 2 then (l[3] * l[3] + e2 * e2) / (e2 + l[3]) else e2 end - 1, 6) v from f2""")
def energy_blend(spark, sf_dir):
    return o.energy_blend(_tiles(spark, sf_dir), ["slice_id", "z", "y", "x"]).withColumn("v", F.round("v", 6))


@query(f"with {_VOX} select slice_id, channel_id, z, y, x, coalesce(v, 0) v from {_GRID} left join vox using (slice_id, channel_id, z, y, x)".replace("from (select slice_id, channel_id from vox group by all), ", "from (select * from (select slice_id, channel_id from vox group by all), ").replace("x) left join", "x)) left join"))
def assemble_volume(spark, sf_dir):
    return o.assemble_volume(vox(spark, sf_dir), SIZES, K).select(*K, "z", "y", "x", "v")


for _a, _rest in {"z": "y, x", "y": "z, x"}.items():

    @query(f"with {_VOX} select slice_id, channel_id, {_rest}, max(v) v from vox group by all", "max_projection" if _a == "z" else f"max_projection_{_a}")
    def _project(spark, sf_dir, axis=_a):
        return o.max_projection(vox(spark, sf_dir), K, axis)


_W = lambda a, f: f"(1 - abs(o_{a} * cast({f} as double) - vox.{a}))"


@query(f"""with {_VOX}, og as (select * from (select cast(unnest(range(0, 8)) as int) o_y), (select cast(unnest(range(0, 6)) as int) o_x), (select cast(unnest(range(0, 10)) as int) o_z))
select slice_id, channel_id, o_z z, o_y y, o_x x, round(sum({_W('x', '3.0')} * {_W('y', '2.0')} * {_W('z', '1.0')} * v), 6) v from vox join og on {_W('x', '3.0')} > 0 and {_W('y', '2.0')} > 0 and {_W('z', '1.0')} > 0 group by all""")
def downsample(spark, sf_dir):
    return o.downsample(vox(spark, sf_dir), K, SIZES, {"x": 3, "y": 2, "z": 1}).withColumn("v", F.round("v", 6))


_FACTOR = {"x": 3.0, "y": 2.2, "z": 1.35}
_STEPS = ", ".join(f"{a}s as (select * from (select cast(unnest(range(0, {int(-(-SIZES[a] // f))})) as int) o_{a}) where o_{a} * cast({f} as double) < {SIZES[a] - 0.5})" for a, f in _FACTOR.items())
_CW = {a: f"(1 - abs(least(o_{a} * cast({f} as double), {SIZES[a] - 1}) - vox.{a}))" for a, f in _FACTOR.items()}


@query(f"""with {_VOX}, {_STEPS}, su as (select slice_id, channel_id, o_z z, o_y y, o_x x, sum({_CW['x']} * {_CW['y']} * {_CW['z']} * v) v
from vox join xs on {_CW['x']} > 0 join ys on {_CW['y']} > 0 join zs on {_CW['z']} > 0 group by all)
select slice_id, channel_id, z, y, x, cast(floor(round(v, 6) + 0.5) as int) v from su where round(v, 6) >= 0.5""")
def downsample_chunks(spark, sf_dir):
    """Steps that are no whole voxels; the last sample along y and z lies past the last voxel's centre."""
    return store.to_voxels(chunks.downsample_chunks(store.from_voxels(vox(spark, sf_dir), K, 8), K, SIZES, _FACTOR, 8))


@query(f"with {_VOX} select slice_id, channel_id, z, cast(round_even(y + z * cast(0.7 as double), 0) as int) y, x, v from vox")
def shear_volume(spark, sf_dir):
    return o.shear_volume(vox(spark, sf_dir), 0.7)


def _warped(sizes: dict[str, int], lo: dict[str, float], origin: dict[str, float]) -> str:
    """Values of the grid that begins at ``lo`` below the slice's corner, from a source whose voxel 0 is at ``origin``."""
    grid = "(select slice_id, channel_id from vox group by all), " + ", ".join(f"(select cast(unnest(range(0, {sizes[a]})) as int) {a})" for a in "zyx")
    d = lambda v: f"cast({v} as double)"
    return f"""with {_VOX}, {sql('surf')}, {FIELD_SQL}, gr as materialized (select (((slice_id * 10 + cast(channel_id as int)) * 16 + z) * 16 + y) * 16 + x point_id, * from {grid}),
pt as materialized (select point_id, slice_id, x * 50.0::double + {d(lo['x'])} x, y * 50.0::double + {d(lo['y'])} y, (slice_id - 1) * 300 + z * 30.0::double + {d(lo['z'])} z from gr), {field_sql('pt', 'mv')},
ps as (select gr.*, (qx - {d(origin['x'])}) / 50 px, (qy - {d(origin['y'])}) / 50 py, (qz - (gr.slice_id - 1) * 300 - {d(origin['z'])}) / 50 pz from gr join mv using (point_id)), {_corner_sql('ps', 'cr')},
su as (select cr.point_id, sum(w * vox.v) v from cr join vox on vox.slice_id = cr.slice_id and vox.channel_id = cr.channel_id and vox.x = s_x and vox.y = s_y and vox.z = s_z group by all)"""


_NONE = dict.fromkeys("xyz", 0.0)
_WARPED = _warped(SIZES, _NONE, _NONE)


@query(f"{_WARPED} select slice_id, channel_id, z, y, x, round(coalesce(v, 0), 4) v from gr left join su using (point_id)")
def warp_slice(spark, sf_dir):
    grid = _grid(spark, sf_dir).withColumn("point_id", F.concat_ws(":", *K, "z", "y", "x"))
    at = grid.select("point_id", "slice_id", (F.col("x") * 50.0).alias("x"), (F.col("y") * 50.0).alias("y"), ((F.col("slice_id") - 1) * 300 + F.col("z") * 30.0).alias("z"))
    moved = g.apply_field(at, field(spark, sf_dir), 100.0, 8, 8, 300.0).select("point_id", "qx", "qy", (F.col("qz") - (F.col("slice_id") - 1) * 300).alias("qz"))
    out = o.warp_slice(grid, vox(spark, sf_dir), moved, K, SIZES, 50.0)
    return out.select(*K, "z", "y", "x", F.round("v", 4).alias("v"))


@query(f"{_WARPED} select slice_id, channel_id, z, y, x, cast(floor(round(v, 6) + 0.5) as int) v from gr join su using (point_id) where round(v, 6) >= 0.5")
def warp_chunks(spark, sf_dir):
    stored = store.from_voxels(vox(spark, sf_dir), K, 8)
    return store.to_voxels(chunks.warp_chunks(stored, K, field(spark, sf_dir), SIZES, SIZES, 8, {"x": 50.0, "y": 50.0, "z": 30.0}, 50.0, 100.0, 8, 8, 300.0))


_ROI = {"x": (-60.0, 545.0), "y": (130.0, 790.0), "z": (40.0, 275.0)}
_SPACING = {"x": 50.0, "y": 50.0, "z": 30.0}
_ORIGIN = {"x": 20.0, "y": -35.0, "z": 10.0}


@query(f"{_warped(chunks.region_sizes(_ROI, _SPACING), {a: r[0] for a, r in _ROI.items()}, _ORIGIN)} select slice_id, channel_id, z, y, x, cast(floor(round(v, 6) + 0.5) as int) v from gr join su using (point_id) where round(v, 6) >= 0.5")
def warp_chunks_region(spark, sf_dir):
    """A region that begins before the slice along x and inside it along y and z, from a source that is moved."""
    stored = store.from_voxels(vox(spark, sf_dir), K, 8)
    return store.to_voxels(chunks.warp_chunks(stored, K, field(spark, sf_dir), SIZES, SIZES, 8, _SPACING, 50.0, 100.0, 8, 8, 300.0, _ROI, _ORIGIN))


@query(f"with {_VOX} select distinct slice_id, z k, cast((slice_id - 1) * 75 + z as int) plane, slice_id || '/Z' || lpad(cast((slice_id - 1) * 75 + z as varchar), 5, '0') || '_C488' as \"name\", cast(0.004 as double) spacing_mm from vox")
def brain_planes(spark, sf_dir):
    return o.brain_planes(vox(spark, sf_dir).select("slice_id", F.col("z").alias("k")).distinct(), 300.0, 4.0, "488")


@query(f"with {_VOX}, p as (select distinct slice_id, channel_id, z from vox), r as (select *, (row_number() over (partition by slice_id, channel_id order by z) - 1) // 3 slab from p), f as (select *, min(z) over (partition by slice_id, channel_id, slab) first_z from r) select slice_id, channel_id, cast(slab as int) slab, first_z, y, x, max(v) v from vox join f using (slice_id, channel_id, z) group by all")
def slab_projection(spark, sf_dir):
    return o.slab_projection(vox(spark, sf_dir), 3)


@query(f"with {_VOX} select z, (slice_id % 3) * 16 + y y, (slice_id // 3) * 16 + x x, max(v) v from vox where z between 2 and 7 and (slice_id // 3) * 16 + x < 40 and (slice_id % 3) * 16 + y < 44 group by all")
def mosaic(spark, sf_dir):
    tiles = vox(spark, sf_dir).select(F.expr("cast(slice_id div 3 as int)").alias("kx"), (F.col("slice_id") % 3).alias("ky"), "z", F.col("y").alias("ly"), F.col("x").alias("lx"), "v")
    return o.mosaic(tiles, 16, 40, 44, 2, 8)


@query(f"with {_VOX} select slice_id, channel_id, z, y, x, v from vox where v > 0")
def to_voxels(spark, sf_dir):
    return store.to_voxels(store.from_voxels(vox(spark, sf_dir), K, 8))


@query(f"with {_VOX} select slice_id, channel_id, z // 8 cz, y // 8 cy, x // 8 cx, count(*) filter (where v > 0) filled, sum(v) total from vox group by all having max(v) > 0")
def from_voxels(spark, sf_dir):
    return store.chunk_sums(store.from_voxels(vox(spark, sf_dir), K, 8), K)


@query(f"with {_VOX} select slice_id, channel_id, y, x, max(v) v from vox group by all having max(v) > 0")
def max_projection_chunks(spark, sf_dir):
    return store.max_projection_chunks(store.from_voxels(vox(spark, sf_dir), K, 8), K)


@query(f"with {sql('frm')}, p as (select slice_id, column_id, frame, count(*) n, sum(v) s from frm group by all), w as (select distinct slice_id, column_id from p), q as (select *, cast(unnest(range(50, 60)) as int) frame from w) select slice_id, column_id, frame, coalesce(n, 0) n, cast(coalesce(s, 0) as bigint) s, n is null missing from q left join p using (slice_id, column_id, frame)")
def read_frames(spark, sf_dir):
    frames = view(spark, sf_dir, "frm").groupBy("slice_id", "column_id", "frame").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    got = store.read_frames(frames, ["slice_id", "column_id"], 50, 60)
    return got.select("slice_id", "column_id", "frame", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("s", F.lit(0)).cast("bigint").alias("s"), "missing")


@query(f"with {sql('frm')}, p as (select slice_id, column_id, frame, sum(v) s from frm group by all), w as (select distinct slice_id, column_id from p), q as (select *, cast(unnest(range(50, 60)) as int) frame from w) select slice_id, column_id, frame, 2 height, 2 width, cast(4 as double) spacing, lpad(coalesce(hex(cast(s as bigint)), '0'), 16, '0') data from q left join p using (slice_id, column_id, frame)")
def read_frame_pixels(spark, sf_dir):
    """Thumbnails of 2 x 2 pixels of frames 8 pixels wide."""
    frames = view(spark, sf_dir, "frm").groupBy("slice_id", "column_id", "frame").agg(F.unhex(F.lpad(F.hex(F.sum("v")), 16, "0")).alias("data"))
    got = store.read_frame_pixels(frames, ["slice_id", "column_id"], 50, 60, 2, 2, 8)
    return got.withColumn("data", F.hex("data"))


@query(f"with {_VOX} select slice_id, channel_id, z, y, x, least(((v + 8) >> 4) << 4, 65520) v from vox where v >= 8")
def write_planes(spark, sf_dir):
    """Chunks written as quantised planes, and what is read back."""
    path = fresh_path(spark, "planes")
    store.write_planes(store.from_voxels(vox(spark, sf_dir), K, 8), path, K, quantized=True)
    kinds = "z int, y0 int, height int, width int, data binary, slice_id int, channel_id string"
    return store.planes_to_voxels(store.read_planes(spark, path, kinds), K)
