"""Dataset manifests, reconstruction indexes, slice geometry, parameters and product lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHANNEL = "struct<ChannelId:string,ChannelName:string,LaserWavelength:string,Objective:string,ExposureTime:double>"
MANIFEST = f"Channels array<{CHANNEL}>, `Acquisition Results` array<struct<SliceID:string,FlsmList:array<string>>>, `Project Info` struct<`Project Name`:string,`Subproject Name`:string,`Animal ID`:string>, Reconstruction map<string,string>"
GEOMETRY = "sphere array<array<double>>, column_spheres map<string,array<array<double>>>, transforms map<string,array<double>>, stack_source string, image_source string, image_origin array<double>, image_spacing array<double>, version string"


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, json) of whole files."""
    return spark.read.format("text").option("wholetext", True).load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))


def read_dataset(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(channels, acquisitions) of manifest texts (path, json).

    The k-th file of a slice belongs to the k-th channel; an empty path is no
    acquisition; relative paths are joined to the manifest's folder.
    """
    m = files.select(F.regexp_replace("path", "[^/]*$", "").alias("dir"), F.from_json("json", MANIFEST).alias("m"))
    info = F.col("m.`Project Info`")
    name = F.concat_ws("_", info["Project Name"], info["Subproject Name"], info["Animal ID"])
    base = m.select("dir", name.alias("dataset"), "m")
    channels = base.select("dataset", F.posexplode("m.Channels").alias("channel_ord", "c")).select(
        "dataset",
        "channel_ord",
        F.col("c.ChannelId").alias("channel_id"),
        F.col("c.ChannelName").alias("channel_name"),
        F.col("c.LaserWavelength").alias("laser_wavelength"),
        F.col("c.Objective").alias("objective"),
    )
    slices = base.select("dir", "dataset", "m.Channels", F.explode("m.`Acquisition Results`").alias("a"))
    files = slices.select("dir", "dataset", "Channels", F.floor(F.col("a.SliceID").cast("double")).cast("int").alias("slice_id"), F.posexplode("a.FlsmList").alias("k", "file"))
    files = files.where((F.col("file") != "") & (F.col("k") < F.size("Channels")))
    path = F.when(F.col("file").rlike("^/"), F.col("file")).otherwise(F.concat("dir", "file"))
    return channels, files.select("dataset", "slice_id", F.element_at("Channels", F.col("k") + 1)["ChannelId"].alias("channel_id"), path.alias("path"))


INDEX = "SliceTransform map<string,struct<ChannelName:string,SliceID:string>>, BrainTransform map<string,string>"


def index_entries(files: DataFrame, folder: str) -> DataFrame:
    """What ``read_reconstruction_index`` takes, of index texts (json) in a dataset's folder.

    An index maps a file's name to its channel's name and slice, or to facts on a brain.
    Texts without such a map, and unreadable ones, give no entries.
    """
    d = files.select(F.from_json("json", INDEX).alias("d"))
    at = lambda kind: F.concat(F.lit(f"{folder.rstrip('/')}/Reconstruction/{kind}/"), F.col("file"))
    path = lambda kind: F.when(F.col("file").startswith("/"), F.col("file")).otherwise(at(kind)).alias("path")
    slices = d.select(F.posexplode("d.SliceTransform").alias("ord", "file", "v")).select("ord", path("SliceTransform"), F.lit("slice").alias("kind"), F.col("v.ChannelName").alias("channel_name"), F.expr("cast(floor(cast(v.SliceID as double)) as string)").alias("slice_id"))
    none = F.lit(None).cast("string")
    brains = d.select(F.posexplode("d.BrainTransform").alias("ord", "file", "v")).select("ord", path("BrainTransform"), F.lit("brain").alias("kind"), none.alias("channel_name"), none.alias("slice_id"))
    return slices.union(brains)


def read_reconstruction_index(entries: DataFrame, channels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Slice transforms and the brain transform of index entries (ord, path, kind, channel_name, slice_id).

    A name that several channels share goes to the first; the last brain entry wins.
    """
    first = channels.groupBy("channel_name").agg(F.min_by("channel_id", "channel_ord").alias("channel_id"))
    slices = entries.where("kind = 'slice'").join(F.broadcast(first), "channel_name")
    return slices.select("channel_id", F.col("slice_id").cast("int").alias("slice_id"), "path"), entries.where("kind = 'brain'").agg(F.max_by("path", "ord").alias("path"))


def write_dataset(channels: DataFrame, acquisitions: DataFrame, folder: str) -> DataFrame:
    """(slice_id, files): paths in channel order, '' where missing, relative to the folder."""
    listed = F.sort_array(F.collect_list(F.struct("channel_ord", "channel_id"))).alias("order")
    order = channels.agg(listed)  # one row: a manifest has a few channels
    relative = F.when(F.startswith(F.col("path"), F.lit(folder)), F.substr("path", F.lit(len(folder) + 1))).otherwise(F.col("path"))
    per = acquisitions.groupBy("slice_id").agg(F.map_from_entries(F.collect_list(F.struct("channel_id", relative))).alias("by"))
    joined = per.join(F.broadcast(order), F.lit(True))
    return joined.select("slice_id", F.transform("order", lambda c: F.coalesce(F.element_at("by", c["channel_id"]), F.lit(""))).alias("files"))


def build_dataset(headers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(channels, acquisitions, project) of raw headers (ord, slice_index, wave_length, pixel_size, caption, file).

    Channels are numbered by first appearance of their wavelength. The last header of a
    (wavelength, slice) wins; a channel's fields come from the slice listed first, the
    project's from the last channel.
    """
    last = headers.groupBy("wave_length", "slice_index").agg(F.min("ord").alias("seen"), F.max_by(F.struct("file", "pixel_size", "caption"), "ord").alias("h"))
    by = last.groupBy("wave_length").agg(F.min("seen").alias("seen"), F.min_by("h", "seen").alias("h"))
    rank = F.row_number().over(Window.orderBy("seen"))  # a handful of wavelengths
    objective = F.when(F.col("h.pixel_size") < 0.6, "20").otherwise("10")
    channels = by.select(rank.alias("channel_ord"), "wave_length", objective.alias("objective"), F.col("h.caption").alias("caption"))
    channels = channels.withColumn("channel_id", F.col("channel_ord").cast("string")).withColumn("channel_name", F.format_string("%snm_%sX", "wave_length", "objective"))
    acquisitions = last.join(F.broadcast(channels.select("wave_length", "channel_id")), "wave_length").select(F.col("slice_index").alias("slice_id"), "channel_id", F.col("h.file").alias("path"))
    parts = F.split(F.max_by("caption", "channel_ord"), "_")
    project = channels.agg(parts.alias("p")).select(F.get("p", F.lit(0)).alias("project"), F.get("p", F.lit(1)).alias("subproject"), F.element_at("p", -1).alias("animal"))
    return channels.drop("caption"), acquisitions, project


def read_slice_geometry(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(boxes, transforms) of slice geometry texts (slice_id, json)."""
    g = files.select("slice_id", F.from_json("json", GEOMETRY).alias("g"))
    at = lambda end, axis: F.col("g.sphere")[end][axis]
    boxes = g.select("slice_id", *[at(e, a).alias(f"{n}_{x}") for e, n in enumerate(("lo", "hi")) for a, x in enumerate("xyz")], F.coalesce("g.version", F.lit("0.2.0")).alias("version"))
    return boxes, g.select("slice_id", F.explode("g.transforms").alias("column_id", "params")).withColumn("column_id", F.col("column_id").cast("int"))


def read_column_spheres(files: DataFrame) -> DataFrame:
    """(slice_id, column_id, lo_*, hi_*): the box of each column of slice geometry texts (slice_id, json)."""
    c = files.select("slice_id", F.explode(F.from_json("json", GEOMETRY)["column_spheres"]).alias("column_id", "b"))
    return c.select("slice_id", F.col("column_id").cast("int").alias("column_id"), *[F.col("b")[e][a].alias(f"{n}_{x}") for e, n in enumerate(("lo", "hi")) for a, x in enumerate("xyz")])


def read_slice_sources(files: DataFrame) -> DataFrame:
    """(slice_id, stack_source, image_source, image_origin, image_spacing) of texts (slice_id, path, json).

    An image's path is joined to the text's folder; without an image its origin and spacing are null.
    """
    g = files.select("slice_id", F.regexp_replace("path", "[^/]*$", "").alias("dir"), F.from_json("json", GEOMETRY).alias("g"))
    image = F.col("g.image_source")
    path = F.when(image.startswith("/"), image).otherwise(F.concat("dir", image))
    return g.select("slice_id", "g.stack_source", path.alias("image_source"), *[F.when(image.isNotNull(), F.col(f"g.{c}")).alias(c) for c in ("image_origin", "image_spacing")])


def _sphere() -> Column:
    return F.array(*[F.array(*[F.col(f"{e}_{x}").cast("double") for x in "xyz"]) for e in ("lo", "hi")])


def write_slice_files(boxes: DataFrame, transforms: DataFrame, column_boxes: DataFrame, sources: DataFrame, version: str) -> DataFrame:
    """(slice_id, json) with every key: boxes, transforms, boxes of columns and sources, as the readers give them.

    Paths of images are written as they are. A slice has a handful of columns, so its maps are small.
    """
    entry = lambda v: F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("column_id").cast("string"), v))))
    maps = transforms.groupBy("slice_id").agg(entry(F.col("params")).alias("transforms"))
    columns = column_boxes.groupBy("slice_id").agg(entry(_sphere()).alias("column_spheres"))
    out = boxes.withColumn("sphere", _sphere()).join(maps, "slice_id", "left").join(columns, "slice_id", "left").join(sources, "slice_id", "left")
    keys = ["sphere", "column_spheres", "transforms", "stack_source", "image_source", "image_origin", "image_spacing"]
    return out.select("slice_id", F.to_json(F.struct(*keys, F.lit(version).alias("version"))).alias("json"))


def write_slice_geometry(boxes: DataFrame, transforms: DataFrame) -> DataFrame:
    """(slice_id, json) from boxes (lo_*, hi_*) and transforms (column_id, params)."""
    per = transforms.groupBy("slice_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("column_id").cast("string"), "params")))).alias("transforms"))
    return boxes.join(per, "slice_id", "left").select("slice_id", F.to_json(F.struct(_sphere().alias("sphere"), "transforms", F.lit("0.2.0").alias("version"))).alias("json"))


def read_params(files: DataFrame, skip_comments: bool = False) -> DataFrame:
    """(path, key, values) of parameter texts (path, json): ``(key v1 v2)`` lines, the last of a key wins.

    Lines without a bracket are skipped. A commented line has one and is read, unless
    ``skip_comments``. Quotes are taken off; values stay text.
    """
    words = F.split(F.trim(F.regexp_replace(_inside(), '"', "")), r"\s+")
    keyed = _param_lines(files, skip_comments).select("path", "pos", words.alias("w")).select("path", "pos", F.element_at("w", 1).alias("key"), F.slice("w", 2, F.size("w")).alias("values"))
    return keyed.groupBy("path", "key").agg(F.max_by("values", "pos").alias("values"))


def _param_lines(files: DataFrame, skip_comments: bool) -> DataFrame:
    lines = files.select("path", F.posexplode(F.split("json", "\n")).alias("pos", "line")).where(F.contains("line", F.lit("(")))
    return lines.where(~F.ltrim("line").startswith("//")) if skip_comments else lines


def _inside() -> Column:
    return F.regexp_extract("line", r"\(([^)]*)", 1)


#: What an unquoted value must look like to be a number.
_NUMBER = r"(?i)^[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity|nan)$"


def read_typed_params(files: DataFrame, skip_comments: bool = False) -> DataFrame:
    """(path, key, pos, text, number): the values of ``read_params`` by kind, a row a value.

    A quoted value is text, an unquoted one a number; an unquoted value that is no number
    leaves both null. A key without values has one row without a position.
    """
    words = F.split(F.trim(_inside()), r"\s+")
    keyed = _param_lines(files, skip_comments).select("path", "pos", words.alias("w"))
    last = keyed.groupBy("path", F.element_at("w", 1).alias("key")).agg(F.max_by(F.slice("w", 2, F.size("w")), "pos").alias("values"))
    each = last.select("path", "key", F.posexplode_outer("values").alias("pos", "v"))
    text = F.when(F.col("v").startswith('"'), F.regexp_extract("v", '^"(.*?)"?$', 1))
    return each.select("path", "key", "pos", text.alias("text"), F.when(F.col("v").rlike(_NUMBER), F.col("v").cast("double")).alias("number"))


def read_points(files: DataFrame) -> DataFrame:
    """(path, point_id, x, y, z) of point texts (path, json): a header, a count, then coordinates.

    Reading stops at a line of fewer than three characters, or after the count. Lines of
    a transformed output list hold the point in their fifth ``;`` field.
    """
    lines = files.select("path", F.posexplode(F.split("json", "\n")).alias("pos", "line"))
    by = Window.partitionBy("path").orderBy("pos")
    count = F.max(F.when(F.col("pos") == 1, F.expr("try_cast(trim(line) as int)"))).over(Window.partitionBy("path"))
    short = F.sum(F.when((F.col("pos") > 1) & (F.length("line") < 3), 1).otherwise(0)).over(by)
    body = lines.withColumn("n", count).withColumn("short", short).where("pos > 1 and short = 0 and pos < n + 2")
    field = F.when(F.contains("line", F.lit(";")), F.regexp_extract(F.get(F.split("line", ";"), F.lit(4)), r"\[([^\]]*)\]", 1)).otherwise(F.col("line"))
    v = F.split(F.trim(field), r"\s+")
    return body.select("path", (F.col("pos") - 2).alias("point_id"), *[F.get(v, F.lit(k)).cast("double").alias(x) for k, x in enumerate("xyz")])


def write_points(points: DataFrame, per_file: int = 100_000) -> DataFrame:
    """(path, json): point texts from (point_id, x, y, z), a line a point, in the order of the ids.

    Ids are cut into ranges of ``per_file``, each a text of its own with its count, so that
    a text is bounded and all are made side by side; ``path`` numbers the ranges.
    """
    line = F.concat_ws(" ", *[F.col(x).cast("string") for x in "xyz"])
    keyed = points.select(F.floor(F.col("point_id") / per_file).cast("string").alias("path"), F.struct("point_id", line.alias("l")).alias("p"))
    rows = keyed.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("p")).alias("p"))
    return rows.select("path", F.concat_ws("\n", F.lit("point"), F.col("n").cast("string"), F.array_join(F.transform("p", lambda p: p["l"]), "\n")).alias("json"))


def resolve_params(*levels: DataFrame) -> DataFrame:
    """Key by key the value of the last level that has it: defaults, preset, user."""
    ranked = None
    for k, level in enumerate(levels):
        part = level.select("key", "value", F.lit(k).alias("level"))
        ranked = part if ranked is None else ranked.union(part)
    return ranked.groupBy("key").agg(F.max_by("value", "level").alias("value"))


def product_index(products: DataFrame) -> DataFrame:
    """(category, path, meta): the relative paths of each category with slice, channel and pixel size, a row a path.

    A path that comes twice in a category stays once, with its largest ``meta``.
    """
    meta = F.struct("slice_id", "channel_name", "pixel_size").alias("meta")
    return products.select(F.explode("category").alias("category"), "path", meta).groupBy("category", "path").agg(F.max("meta").alias("meta"))


#: The entry of a category's facts that points to the index it rests on.
_RESTS_ON = {
    "Projection": ("Transform", "../SliceTransform/SliceTransform.json"),
    "SliceImage": ("Transform", "../SliceTransform/SliceTransform.json"),
    "BrainImage": ("Transform", "../BrainTransform/BrainTransform.json"),
    "BrainProjection": ("BrainImage", "../BrainImage/BrainImage.json"),
}


def category_info(index: DataFrame, facts: dict[str, str], pixel_size: Column | None = None) -> DataFrame:
    """(category, info): what an index says of a category as a whole, a map of texts, a row for each category of ``product_index``.

    ``facts`` (software, version, time) go to every category; ``pixel_size``, an expression on
    the rows of ``index``, to projections alone. A category other than the known ones has its
    type and the facts only.
    """
    by = index.groupBy("category").agg((F.max(pixel_size) if pixel_size is not None else F.lit(None)).cast("string").alias("pixel_size"))
    common = [F.lit(v) for pair in {"Parameter": "../Parameters.json", **facts}.items() for v in pair]
    is_one = lambda *names: F.col("category").isin(*names)
    rests = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    for name, (key, path) in _RESTS_ON.items():
        rests = F.when(is_one(name), F.create_map(F.lit(key), F.lit(path))).otherwise(rests)
    size = F.when(is_one("Projection") & F.col("pixel_size").isNotNull(), F.create_map(F.lit("PixelSize"), F.col("pixel_size"))).otherwise(F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>")))
    return by.select("category", F.map_concat(F.create_map(F.lit("Type"), F.col("category"), *common), rests, size).alias("info"))


def pending_products(outputs: DataFrame) -> DataFrame:
    """Tasks (task_id, output_id, done) with an output that isn't there; the others are skipped."""
    return outputs.groupBy("task_id").agg(F.bool_and("done").alias("all_done"), F.count(F.lit(1)).alias("n_outputs"), F.count_if(~F.col("done")).alias("n_missing")).where("not all_done").drop("all_done")


def matches_list(value: Column, names: Column) -> Column:
    """Whether a value stands in a comma list; a null list is empty."""
    return F.coalesce(F.array_contains(F.split(names, ","), value), F.lit(False))
