"""Queries over manifests, indexes, parameters and products, from raw-file headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.plans.catalog import query
from lamella.plans.views import sql, view
from lamella.sources import manifest as m

_BUILT = f"""{sql('hdr')},
l as (select wave_length, slice_index, min(ord) seen, max_by(file, ord) file, max_by(pixel_size, ord) pixel_size, max_by(caption, ord) caption from hdr group by all),
w as (select wave_length, min(seen) seen, min_by(pixel_size, seen) pixel_size, min_by(caption, seen) caption from l group by all),
ch as (select cast(row_number() over (order by seen) as int) channel_ord, wave_length, case when pixel_size < 0.6 then '20' else '10' end objective, caption,
  cast(row_number() over (order by seen) as varchar) channel_id, wave_length || 'nm_' || case when pixel_size < 0.6 then '20' else '10' end || 'X' channel_name from w),
acq as (select slice_index slice_id, channel_id, file path from l join ch using (wave_length))"""


def built(spark, sf_dir):
    return m.build_dataset(view(spark, sf_dir, "hdr"))


@query(f"with {_BUILT} select channel_ord, wave_length, objective, channel_id, channel_name from ch")
def build_dataset(spark, sf_dir):
    return built(spark, sf_dir)[0]


@query(f"with {_BUILT} select slice_id, channel_id, path from acq")
def build_acquisitions(spark, sf_dir):
    return built(spark, sf_dir)[1]


@query(f"with {_BUILT} select split_part(max_by(caption, channel_ord), '_', 1) project, split_part(max_by(caption, channel_ord), '_', 2) subproject, split_part(max_by(caption, channel_ord), '_', -1) animal from ch")
def build_project(spark, sf_dir):
    return built(spark, sf_dir)[2]


def manifest_json(spark, sf_dir):
    """The built dataset as one manifest text."""
    channels, acquisitions, _ = built(spark, sf_dir)
    listed = m.write_dataset(channels, acquisitions, "raw/")
    ch = channels.agg(F.transform(F.sort_array(F.collect_list(F.struct("channel_ord", "channel_id", "channel_name", "wave_length", "objective"))), lambda c: F.struct(c["channel_id"].alias("ChannelId"), c["channel_name"].alias("ChannelName"), c["wave_length"].alias("LaserWavelength"), c["objective"].alias("Objective"))).alias("Channels"))
    ac = listed.agg(F.collect_list(F.struct(F.col("slice_id").cast("string").alias("SliceID"), F.col("files").alias("FlsmList"))).alias("Acquisition Results"))
    info = F.struct(F.lit("P").alias("Project Name"), F.lit("S").alias("Subproject Name"), F.lit("A").alias("Animal ID")).alias("Project Info")
    return ch.join(ac, F.lit(True)).select(F.lit("/data/set.json").alias("path"), F.to_json(F.struct("Channels", "`Acquisition Results`", info)).alias("json"))


@query(f"with {_BUILT} select 'P_S_A' dataset, slice_id, channel_id, '/data/' || substr(path, 5) path from acq")
def read_dataset(spark, sf_dir):
    return m.read_dataset(manifest_json(spark, sf_dir))[1]


@query(f"with {_BUILT} select 'P_S_A' dataset, channel_ord - 1 channel_ord, channel_id, channel_name, wave_length laser_wavelength, objective from ch")
def read_dataset_channels(spark, sf_dir):
    return m.read_dataset(manifest_json(spark, sf_dir))[0]


@query(f"with {_BUILT} select slice_id, string_agg(coalesce(substr(path, 5), ''), '|' order by channel_ord) files from (select distinct slice_id from acq) cross join ch left join acq using (slice_id, channel_id) group by slice_id")
def write_dataset(spark, sf_dir):
    channels, acquisitions, _ = built(spark, sf_dir)
    return m.write_dataset(channels, acquisitions, "raw/").select("slice_id", F.array_join("files", "|").alias("files"))


@query(f"with {_BUILT}, f as (select min(channel_ord) o, channel_name from ch group by all) select ch.channel_id, cast(hdr.slice_index as int) slice_id, hdr.file path from hdr join ch on ch.wave_length = hdr.wave_length join f on f.o = ch.channel_ord")
def read_reconstruction_index(spark, sf_dir):
    channels = built(spark, sf_dir)[0]
    entries = view(spark, sf_dir, "hdr").join(channels.select("wave_length", "channel_name"), "wave_length").select("ord", F.col("file").alias("path"), F.lit("slice").alias("kind"), "channel_name", F.col("slice_index").cast("string").alias("slice_id"))
    return m.read_reconstruction_index(entries, channels)[0]


@query(f"with {_BUILT}, f as (select min(channel_ord) o, channel_name from ch group by all) select ch.channel_id, cast(hdr.slice_index as int) slice_id, '/data/Reconstruction/SliceTransform/' || hdr.file path from hdr join ch on ch.wave_length = hdr.wave_length join f on f.o = ch.channel_ord")
def read_index_json(spark, sf_dir):
    """Index texts, one for each slice, made of the headers."""
    channels = built(spark, sf_dir)[0]
    h = view(spark, sf_dir, "hdr").join(channels.select("wave_length", "channel_name"), "wave_length")
    entry = F.struct("file", F.struct(F.col("channel_name").alias("ChannelName"), F.col("slice_index").cast("string").alias("SliceID")))
    texts = h.groupBy("slice_index").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("SliceTransform"))).alias("json"))
    return m.read_reconstruction_index(m.index_entries(texts, "/data"), channels)[0]


@query("select max_by('raw/' || s_name || '.flsm', s_suppkey) path from supplier")
def brain_transform_path(spark, sf_dir):
    h = view(spark, sf_dir, "hdr").select("ord", F.col("file").alias("path"), F.lit("brain").alias("kind"), F.lit(None).cast("string").alias("channel_name"), F.lit(None).cast("string").alias("slice_id"))
    return m.read_reconstruction_index(h, built(spark, sf_dir)[0])[1]


def _geometry(spark, sf_dir):
    c = view(spark, sf_dir, "cols")
    boxes = c.groupBy("slice_id").agg(F.min("stage_x").alias("lo_x"), F.min("stage_y").alias("lo_y"), F.lit(0.0).alias("lo_z"), F.max("stage_x").alias("hi_x"), F.max("stage_y").alias("hi_y"), F.lit(300.0).alias("hi_z"))
    return m.write_slice_geometry(boxes, c.select("slice_id", "column_id", F.array("spacing", "stage_x", "stage_y").alias("params")))


@query(f"with {sql('cols')} select slice_id, column_id, unnest([0, 1, 2]) k, unnest([spacing, stage_x, stage_y]) p from cols")
def read_slice_geometry(spark, sf_dir):
    return m.read_slice_geometry(_geometry(spark, sf_dir))[1].select("slice_id", "column_id", F.posexplode("params").alias("k", "p"))


@query(f"with {sql('cols')} select slice_id, min(stage_x) lo_x, min(stage_y) lo_y, cast(0 as double) lo_z, max(stage_x) hi_x, max(stage_y) hi_y, cast(300 as double) hi_z, '0.2.0' version from cols group by slice_id")
def write_slice_geometry(spark, sf_dir):
    return m.read_slice_geometry(_geometry(spark, sf_dir))[0]


def _slice_files(spark, sf_dir):
    """Slice texts with every key; odd slices have no image."""
    c = view(spark, sf_dir, "cols")
    ends = lambda df: df.agg(F.min("stage_x").alias("lo_x"), F.min("stage_y").alias("lo_y"), F.lit(0.0).alias("lo_z"), F.max("stage_x").alias("hi_x"), F.max("stage_y").alias("hi_y"), F.lit(300.0).alias("hi_z"))
    image = F.when(F.col("slice_id") % 2 == 0, F.concat(F.lit("img/"), "slice_id"))
    triple = lambda v: F.when(F.col("slice_id") % 2 == 0, F.array(F.col("slice_id") * v, F.lit(v), F.lit(0.5)))
    sources = c.select("slice_id").distinct().select("slice_id", F.concat(F.lit("raw/"), "slice_id").alias("stack_source"), image.alias("image_source"), triple(2.5).alias("image_origin"), triple(4.0).alias("image_spacing"))
    texts = m.write_slice_files(ends(c.groupBy("slice_id")), c.select("slice_id", "column_id", F.array("spacing", "stage_x").alias("params")), ends(c.groupBy("slice_id", "column_id")), sources, "0.4.0")
    return texts.withColumn("path", F.lit("/data/SliceTransform/s.json"))


@query(f"with {sql('cols')} select slice_id, column_id, stage_x lo_x, stage_y lo_y, cast(0 as double) lo_z, stage_x hi_x, stage_y hi_y, cast(300 as double) hi_z from cols")
def read_column_spheres(spark, sf_dir):
    return m.read_column_spheres(_slice_files(spark, sf_dir))


@query(f"""with {sql('cols')}, s as (select distinct slice_id, slice_id % 2 = 0 has from cols) select slice_id, 'raw/' || slice_id stack_source, case when has then '/data/SliceTransform/img/' || slice_id end image_source,
 case when has then slice_id * cast(2.5 as double) || '|2.5|0.5' end image_origin, case when has then slice_id * cast(4 as double) || '|4.0|0.5' end image_spacing from s""")
def write_slice_files(spark, sf_dir):
    text = lambda c: F.when(F.col(c).isNotNull(), F.array_join(F.col(c).cast("array<string>"), "|")).alias(c)
    return m.read_slice_sources(_slice_files(spark, sf_dir)).select("slice_id", "stack_source", "image_source", text("image_origin"), text("image_spacing"))


_PARAM_TEXT = "'(Key' || (s_suppkey % 5) || ' ' || s_suppkey || ' \"v\")'"


@query("with t as (select s_nationkey path, s_suppkey % 5 k, max(s_suppkey) v from supplier group by all) select cast(path as varchar) path, 'Key' || k as \"key\", v || '|v' as \"values\" from t")
def read_params(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    lines = s.groupBy(F.col("s_nationkey").cast("string").alias("path")).agg(F.sort_array(F.collect_list(F.struct("s_suppkey", F.expr(_PARAM_TEXT.replace("\\", "")).alias("l")))).alias("l"))
    return m.read_params(lines.select("path", F.concat(F.lit("// no bracket\n"), F.array_join(F.transform("l", lambda x: x["l"]), "\n")).alias("json"))).select("path", "key", F.array_join("values", "|").alias("values"))


@query("""with t as (select s_nationkey, s_suppkey % 5 k, max(s_suppkey) v from supplier group by all), u as (select *, unnest([0, 1, 2, 3]) pos from t)
select cast(s_nationkey as varchar) path, 'Key' || k as "key", cast(pos as int) pos, case pos when 1 then 'v' || v end as "text", case pos when 0 then cast(v as double) when 2 then v * cast(-1000 as double) end "number" from u""")
def read_typed_params(spark, sf_dir):
    """A whole number, a quoted text, a number with an exponent and a bare word on each line."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    line = F.format_string('(Key%d %d "v%d" -%de3 word)', F.col("s_suppkey") % 5, "s_suppkey", "s_suppkey", "s_suppkey")
    texts = s.groupBy(F.col("s_nationkey").cast("string").alias("path")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", line.alias("l")))), lambda x: x["l"]), "\n").alias("json"))
    return m.read_typed_params(texts)


@query(f"with {sql('pts')} select cast(point_id // 1000 as varchar) path, cast(row_number() over (partition by point_id // 1000 order by point_id) - 1 as int) point_id, x, y, z from pts")
def read_points(spark, sf_dir):
    return m.read_points(m.write_points(view(spark, sf_dir, "pts"), 1000))


@query(f"with {sql('pts')} select cast(point_id // 100000 as varchar) path, count(*) n, cast(round(sum(x), 3) as double) sx, cast(round(sum(y), 3) as double) sy, cast(round(sum(z), 3) as double) sz from pts group by 1")
def write_points(spark, sf_dir):
    back = m.read_points(m.write_points(view(spark, sf_dir, "pts")))
    return back.groupBy("path").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.sum(c), 3).alias(f"s{c}") for c in "xyz"])


@query("""with d as (select p_brand k, min(p_partkey) v, 0 l from part group by all union all select p_brand, max(p_partkey), 1 from part where p_size % 2 = 0 group by all
 union all select p_brand, cast(-1 as bigint), 2 from part where p_brand like '%1' group by all) select k as "key", max_by(v, l) as "value" from d group by k""")
def resolve_params(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = F.col("p_brand").alias("key")
    return m.resolve_params(p.groupBy(key).agg(F.min("p_partkey").alias("value")), p.where("p_size % 2 = 0").groupBy(key).agg(F.max("p_partkey").alias("value")), p.where("p_brand like '%1'").groupBy(key).agg(F.lit(-1).cast("bigint").alias("value")))


@query(f"with {sql('hdr')} select category, count(*) n, sum(slice_index) ids, min(file) first_path from (select *, unnest([wave_length, 'all']) category from hdr) group by category")
def product_index(spark, sf_dir):
    h = view(spark, sf_dir, "hdr")
    index = m.product_index(h.select(F.array("wave_length", F.lit("all")).alias("category"), F.col("file").alias("path"), F.col("slice_index").alias("slice_id"), F.col("wave_length").alias("channel_name"), "pixel_size"))
    return index.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("meta.slice_id").alias("ids"), F.min("path").alias("first_path"))


_CATEGORY = {0: "Projection", 1: "SliceImage", 2: "BrainImage", 3: "BrainProjection", 4: "Masks"}


@query(f"""with {sql('hdr')}, c as (select case ord % 5 {' '.join(f"when {k} then '{v}'" for k, v in _CATEGORY.items())} end category, max(pixel_size) p from hdr group by 1)
select category, 'Type' as "key", category as "value" from c union all select category, 'Parameter', '../Parameters.json' from c union all select category, 'Version', '1' from c
union all select category, 'PixelSize', cast(p as varchar) from c where category = 'Projection'
union all select category, 'Transform', case category when 'BrainImage' then '../BrainTransform/BrainTransform.json' else '../SliceTransform/SliceTransform.json' end from c where category in ('Projection', 'SliceImage', 'BrainImage')
union all select category, 'BrainImage', '../BrainImage/BrainImage.json' from c where category = 'BrainProjection'""")
def category_info(spark, sf_dir):
    h = view(spark, sf_dir, "hdr")
    category = F.array(F.element_at(F.array(*[F.lit(v) for v in _CATEGORY.values()]), (F.col("ord") % 5 + 1).cast("int")))
    index = m.product_index(h.select(category.alias("category"), F.col("file").alias("path"), F.col("slice_index").alias("slice_id"), F.col("wave_length").alias("channel_name"), "pixel_size"))
    return m.category_info(index, {"Version": "1"}, F.col("meta.pixel_size")).select("category", F.explode("info"))


@query(f"with {sql('tasks').replace('done from', 'done from')} select task_id, count(*) n_outputs, count(*) filter (where not done) n_missing from tasks group by task_id having not bool_and(done)")
def pending_products(spark, sf_dir):
    return m.pending_products(view(spark, sf_dir, "tasks"))
