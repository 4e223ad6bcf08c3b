"""Imaging tables derived from the test tables, in Spark and as SQL text.

Each view is one column list over one table, written once; Spark spells integer
division ``div`` where the SQL twin spells it ``//``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: name: (table, filter, columns, whether rows are grouped by all columns but the last)
_VIEWS: dict[str, tuple[str, str, list[str], bool]] = {
    "vox": (
        "lineitem",
        "",
        [
            "cast(l_orderkey % 6 + 1 as int) slice_id",
            "case l_returnflag when 'A' then '1' when 'N' then '2' else '3' end channel_id",
            "cast(l_suppkey % 10 as int) z",
            "cast(l_partkey % 16 as int) y",
            "cast((l_orderkey // 6) % 16 as int) x",
            "cast(max(cast(floor(l_extendedprice) as bigint) % 4096) as int) v",
        ],
        True,
    ),
    "cols": (
        "nation",
        "n_nationkey < 24",
        [
            "cast(n_nationkey // 4 + 1 as int) slice_id",
            "'1' channel_id",
            "cast(n_nationkey % 4 as int) column_id",
            "cast(2.0 + 0.5 * (n_nationkey % 3) as double) spacing",
            "cast(1.0 as double) pixel_size",
            "256 width",
            "256 height",
            "64 n_frames",
            "cast(10.0 * (n_nationkey % 4) as double) stage_x",
            "cast(200.0 * (n_nationkey % 4) as double) stage_y",
        ],
        False,
    ),
    "pts": (
        "orders",
        "",
        [
            "o_orderkey point_id",
            "cast((o_orderkey % 997) * 0.75 as double) x",
            "cast((o_custkey % 499) * 1.75 as double) y",
            "cast((o_orderkey % 1850) - 9.75 as double) z",
        ],
        False,
    ),
    "surf": ("embeddings", "", ["cast(vec_id // 4 + 1 as int) slice_id", "cast(vec_id % 4 as int) comp", "embedding"], False),
    "hdr": (
        "supplier",
        "",
        [
            "s_suppkey ord",
            "cast(s_suppkey % 10 as int) slice_index",
            "case s_suppkey % 3 when 0 then '488' when 1 then '561' else '405' end wave_length",
            "cast(case when s_suppkey % 2 = 0 then 0.5 else 1.0 end as double) pixel_size",
            "concat('Proj_Sub_A', cast(s_suppkey % 4 as string)) caption",
            "concat('raw/', s_name, '.flsm') file",
        ],
        False,
    ),
    "tasks": ("orders", "", ["o_custkey task_id", "o_orderkey output_id", "o_orderstatus <> 'P' done"], False),
    "frm": (
        "lineitem",
        "",
        [
            "cast(l_orderkey % 6 + 1 as int) slice_id",
            "cast(l_suppkey % 4 as int) column_id",
            "cast(l_partkey % 200 as int) frame",
            "cast(cast(floor(l_extendedprice) as bigint) % 600 as int) v",
        ],
        False,
    ),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, where, columns, grouped = _VIEWS[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    df = df.where(where) if where else df
    columns = [c.replace("//", "div") for c in columns]
    if not grouped:
        return df.selectExpr(*columns)
    *keys, last = columns
    return df.groupBy(*[F.expr(k.rpartition(" ")[0]).alias(k.rpartition(" ")[2]) for k in keys]).agg(F.expr(last.rpartition(" ")[0]).alias(last.rpartition(" ")[2]))


def sql(*names: str) -> str:
    """WITH items for the views, to be followed by further items or a query."""
    parts = []
    for name in names:
        table, where, columns, grouped = _VIEWS[name]
        parts.append(f"{name} as (select {', '.join(columns)} from {table}{' where ' + where if where else ''}{' group by all' if grouped else ''})")
    return ", ".join(parts)


#: Derived views as SQL. Slice boxes are 800 um wide and 300 um thick; the field grid of a slice is 8 x 8 at 100 um.
SLICES_SQL = "slices as (select i slice_id, cast(0 as double) lo_x, cast(0 as double) lo_y, cast((i - 1) * 300 as double) lo_z, cast(800 as double) hi_x, cast(800 as double) hi_y, cast(i * 300 as double) hi_z from (select cast(unnest(range(1, 7)) as int) i))"
FIELD_SQL = """field as (
  select slice_id, plane, gy, gx, max(case when comp % 2 = 0 then d end) dx, max(case when comp % 2 = 1 then d end) dy, cast(0 as double) dz
  from (select slice_id, comp, comp // 2 plane, cast(k // 8 as int) gy, cast(k % 8 as int) gx, cast(embedding[k + 1] as double) * 40 d
        from surf, (select cast(unnest(range(0, 64)) as int) k)) group by all)"""
#: The 8 x 8 patches as images of bytes: surface 0 is upper, 1 lower.
IMAGE_SQL = """img as (
  select slice_id, comp surface, cast(k // 8 as int) y, cast(k % 8 as int) x, cast(floor((cast(embedding[k + 1] as double) + 0.6) * 200) as int) v
  from surf, (select cast(unnest(range(0, 64)) as int) k) where comp < 2)"""


def slices(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    d = lambda c: F.lit(c).cast("double") if isinstance(c, int) else c.cast("double")
    return spark.range(1, 7).select(i.cast("int").alias("slice_id"), d(0).alias("lo_x"), d(0).alias("lo_y"), d((i - 1) * 300).alias("lo_z"), d(800).alias("hi_x"), d(800).alias("hi_y"), d(i * 300).alias("hi_z"))


def field(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "surf").select("slice_id", "comp", F.posexplode("embedding").alias("k", "e"))
    d = F.col("e").cast("double") * 40
    return cells.groupBy("slice_id", F.expr("cast(comp div 2 as int)").alias("plane"), F.expr("cast(k div 8 as int)").alias("gy"), (F.col("k") % 8).alias("gx")).agg(
        F.max(F.when(F.col("comp") % 2 == 0, d)).alias("dx"), F.max(F.when(F.col("comp") % 2 == 1, d)).alias("dy"), F.lit(0.0).alias("dz")
    ).where("gy < 8")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "surf").where("comp < 2").select("slice_id", F.col("comp").alias("surface"), F.posexplode("embedding").alias("k", "e"))
    v = F.floor((F.col("e").cast("double") + 0.6) * 200).cast("int")
    return cells.where("k < 64").select("slice_id", "surface", F.expr("cast(k div 8 as int)").alias("y"), (F.col("k") % 8).alias("x"), v.alias("v"))
