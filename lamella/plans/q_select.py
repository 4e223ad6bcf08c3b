"""Queries that select channels, slices, templates and frames, and map pixel values."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.functions import pixels
from lamella.operators import select as s
from lamella.plans.catalog import query
from lamella.plans.q_manifest import _BUILT, built
from lamella.plans.views import sql, view


def _channels(spark, sf_dir):
    return built(spark, sf_dir)[0].withColumnRenamed("wave_length", "laser_wavelength").drop("objective")


def _acquired(spark, sf_dir):
    return built(spark, sf_dir)[1]


_CH = "select channel_ord, wave_length laser_wavelength, channel_id, channel_name from ch"


@query(f"with {_BUILT} {_CH} where not (wave_length in ('561') or channel_name in ('561', '405nm_20X'))  and wave_length <> '405nm_20X'")
def filter_channels(spark, sf_dir):
    return s.filter_channels(_channels(spark, sf_dir), "561,405nm_20X", True)


@query(f"with {_BUILT} {_CH} where wave_length in ('561', '405') or channel_name in ('561', '405')")
def filter_channels_inclusive(spark, sf_dir):
    return s.filter_channels(_channels(spark, sf_dir), "561,405", False)


@query(f"with {_BUILT} select slice_id, channel_id, path from acq where slice_id not in (1, 4)")
def filter_slices(spark, sf_dir):
    return s.filter_slices(_acquired(spark, sf_dir), "1,4")


@query(f"with {_BUILT} select channel_ord, wave_length laser_wavelength, channel_id, channel_name, wave_length = '405' is_ref, cast(row_number() over (order by wave_length = '405' desc, cast(channel_id as double)) as int) place from ch")
def order_channels(spark, sf_dir):
    return s.order_channels(_channels(spark, sf_dir), "405")


@query(f"with {_BUILT} select slice_id, channel_id, path from acq where slice_id in (select slice_id from acq where channel_id = '1' and slice_id % 3 > 0)")
def keep_referenced_slices(spark, sf_dir):
    a = _acquired(spark, sf_dir).where("channel_id <> '1' or slice_id % 3 > 0")
    return s.keep_referenced_slices(a, "1")


@query(f"with {_BUILT} {_CH} where wave_length <> '561'")
def stitch_channels(spark, sf_dir):
    return s.stitch_channels(_channels(spark, sf_dir), "561", "1")


@query(f"""with {sql('frm')}, t as (select unnest([300.0, 200.0, 150.0, 125.0, 112.5]) t)
select slice_id, column_id, frame, cast(t as double) threshold, round(avg(case when v between 0 and t then 1.0 else 0.0 end), 9) share, avg(case when v between 0 and t then 1.0 else 0.0 end) > 0.8 background
from frm, t group by all""")
def is_background(spark, sf_dir):
    out = s.is_background(view(spark, sf_dir, "frm"), ["slice_id", "column_id", "frame"])
    return out.withColumn("share", F.round("share", 9))


_TEMPLATE = "case when i > 9 then 9 when i < 0 then 0 else i // 12 end"


@query(f"""with i as (select distinct cast(l_suppkey % 300 - 20 as int) i from lineitem)
select i slice_id, 'mouse' species, least(greatest(i, 1), 46) template, cast(1.0 as double) scale from i
union all select i, 'macaque', least(greatest(i, 1), 250), cast(62.5 as double) from i
union all select i, 'spinal_cord', cast({_TEMPLATE} as int), cast(1.0 as double) from i
union all select i, 'other', cast(null as int), cast(2.5 as double) from i""")
def select_template(spark, sf_dir):
    i = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select((F.col("l_suppkey") % 300 - 20).cast("int").alias("slice_id")).distinct()
    parts = [s.select_template(i, k, 4.0).select("slice_id", F.lit(k).alias("species"), "template", "scale") for k in ("mouse", "macaque", "spinal_cord", "other")]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(f"with {sql('hdr')}, f as (select slice_index, ord % 2 side, min(file) file from hdr where ord % 7 > 0 group by all) select b.slice_index slice_id, a.file lower_file, b.file upper_file from f a join f b on b.slice_index = a.slice_index + 1 and a.side = 0 and b.side = 1")
def anchor_files(spark, sf_dir):
    h = view(spark, sf_dir, "hdr").where("ord % 7 > 0")
    return s.anchor_files(h.groupBy(F.col("slice_index").alias("slice_id"), F.when(F.col("ord") % 2 == 0, "lower").otherwise("upper").alias("side")).agg(F.min("file").alias("file")))


@query(f"with {sql('vox')} select slice_id, channel_id, z, y, x, case when v < 100 or v > 4000 then 0 else v - 100 end v from vox")
def subtract_background(spark, sf_dir):
    return view(spark, sf_dir, "vox").withColumn("v", pixels.subtract_background(F.col("v"), 100, 4000))


@query(f"with {sql('vox')} select slice_id, channel_id, z, y, x, round(case when v > 0 then greatest(0, least(255, (ln(v) - cast(4.6 as double)) * cast(39.4 as double))) else 0 end, 6) v from vox")
def log_intensity(spark, sf_dir):
    return view(spark, sf_dir, "vox").withColumn("v", F.round(pixels.log_intensity(F.col("v")), 6))


@query(f"with {sql('vox')} select slice_id, channel_id, z, y, x, cast(round_even(case when v > 0 then greatest(0, least(255, (ln(v) - cast(4.6 as double)) * cast(39.4 as double))) else 0 end, 0) as int) v from vox")
def log_intensity_byte(spark, sf_dir):
    return view(spark, sf_dir, "vox").withColumn("v", pixels.log_intensity(F.col("v"), True))


@query(f"with {sql('vox')} select slice_id, channel_id, z, y, x, least(((v * 16 + 8) >> 4) << 4, 65520) v from vox")
def quantize(spark, sf_dir):
    return view(spark, sf_dir, "vox").withColumn("v", pixels.quantize(F.col("v") * 16))
