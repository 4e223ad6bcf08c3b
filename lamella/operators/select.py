"""Selection of channels, slices, templates and background frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Thresholds from 300, each 100 + half the excess of the one before, while over 110.
BACKGROUND_THRESHOLDS = (300.0, 200.0, 150.0, 125.0, 112.5)
BACKGROUND_SHARE = 0.8


def _listed(value: Column, names: str | None) -> Column:
    return value.isin([n for n in names.split(",")]) if names is not None else F.lit(False)


def filter_channels(channels: DataFrame, names: str | None, exclusive: bool) -> DataFrame:
    """Drop (exclusive) or keep only the channels whose name or wavelength is in a comma list."""
    hit = _listed(F.col("channel_name"), names) | _listed(F.col("laser_wavelength"), names)
    return channels.where(~hit if exclusive else hit)


def filter_slices(acquisitions: DataFrame, ids: str | None) -> DataFrame:
    """Drop the slices of a comma list of numbers."""
    return acquisitions if ids is None else acquisitions.where(~F.col("slice_id").isin([int(i) for i in ids.split(",") if i.strip()]))


def order_channels(channels: DataFrame, reference: str | None = None) -> DataFrame:
    """Add ``place``: the reference channel first, then by numeric id.

    The reference is the first that matches the given name or wavelength, else the first of all.
    """
    number = F.col("channel_id").cast("double")
    hit = _listed(F.col("channel_name"), reference) | _listed(F.col("laser_wavelength"), reference)
    first = Window.orderBy(hit.desc(), "channel_ord")  # a manifest has a few channels
    marked = channels.withColumn("is_ref", F.row_number().over(first) == 1)
    return marked.withColumn("place", F.row_number().over(Window.orderBy(F.col("is_ref").desc(), number)))


def keep_referenced_slices(acquisitions: DataFrame, reference_id: str) -> DataFrame:
    """Only slices that the reference channel has; channels left empty vanish."""
    return acquisitions.join(acquisitions.where(F.col("channel_id") == reference_id).select("slice_id").distinct(), "slice_id", "left_semi")


def stitch_channels(channels: DataFrame, names: str | None, reference_id: str, include: bool = False) -> DataFrame:
    """Channels to stitch: the reference without a list, all for 'all', else all but the listed ones.

    ``include`` reads the list as the channels to take.
    """
    if names is None:
        return channels.where(F.col("channel_id") == reference_id)
    return channels if names == "all" else filter_channels(channels, names, not include)


def is_background(frames: DataFrame, keys: list[str], thresholds: tuple[float, ...] = BACKGROUND_THRESHOLDS) -> DataFrame:
    """(keys, threshold, share, background) of pixels (keys, v): background when over 0.8 of them are in [0, threshold].

    All thresholds are counted in one aggregation, then turned into rows.
    """
    shares = F.array(*[F.struct(F.lit(t).alias("threshold"), F.avg(F.when((F.col("v") >= 0) & (F.col("v") <= t), 1.0).otherwise(0.0)).alias("share")) for t in thresholds])
    rows = frames.groupBy(*keys).agg(shares.alias("s")).select(*keys, F.explode("s").alias("s"))
    return rows.select(*keys, "s.threshold", "s.share", (F.col("s.share") > BACKGROUND_SHARE).alias("background"))


def select_template(slices: DataFrame, species: str, pixel_size: float) -> DataFrame:
    """Add template number and scale for a species.

    For the spinal cord the number is i // 12, made 9 where i > 9 and 0 where i < 0; the
    tests are on i itself, as in the original rule.
    """
    i = F.col("slice_id")
    rules = {
        "mouse": (F.least(F.greatest(i, F.lit(1)), F.lit(46)), 4.0),
        "macaque": (F.least(F.greatest(i, F.lit(1)), F.lit(250)), 250.0),
        "spinal_cord": (F.when(i > 9, 9).when(i < 0, 0).otherwise(F.floor(i / 12)), 4.0),
    }
    number, scale = rules.get(species, (F.lit(None), 10.0))
    return slices.withColumn("template", number.cast("int")).withColumn("scale", F.lit(scale / pixel_size))


def anchor_files(files: DataFrame) -> DataFrame:
    """(slice_id, lower_file, upper_file) where slice - 1 has a lower and the slice an upper point file."""
    lower = files.where("side = 'lower'").select((F.col("slice_id") + 1).alias("slice_id"), F.col("file").alias("lower_file"))
    return lower.join(files.where("side = 'upper'").select("slice_id", F.col("file").alias("upper_file")), "slice_id")
