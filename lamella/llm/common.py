"""Shared pieces: tables, the shared scratch folder, row keys and written intermediates."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the separators of the word contracts, as a Java regex class.
SPACES = r"[\x20\x09-\x0D]+"

#: Frees the shuffle files of a finished write at once, not when the driver collects its garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir where it is set.

    A local session without that setting gets a fresh temporary folder; on a
    cluster its absence is an error, because no folder can be guessed there.
    """
    context = spark.sparkContext
    given = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lamella-"))
    return context.getCheckpointDir().rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate, through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Written intermediates of one run, below the shared folder.

    ``keep`` writes a DataFrame as Parquet and returns the written table, which
    cuts lineage and survives the loss of any executor. Tables live until
    ``drop`` or the end of the driver, as results are read from them lazily.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/lamella-{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        atexit.register(self._forget)

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        before = self.spark.conf.get(_FREE_SHUFFLES, None)
        self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(_FREE_SHUFFLES) if before is None else self.spark.conf.set(_FREE_SHUFFLES, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove(self.spark, t._scratch_path)

    def _forget(self) -> None:
        try:
            remove(self.spark, self.root)
        except Exception:  # noqa: BLE001 - the session is already gone
            pass


def _of_files(df: DataFrame) -> bool:
    """Whether ``df`` only selects and filters the rows of one file source."""
    node = df._jdf.queryExecution().analyzed()
    if not node.deterministic():
        return False
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().apply(0)
    return node.nodeName() == "LogicalRelation"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_keyed(df: DataFrame, name: str = "_row") -> DataFrame:
    """Add a unique row key that comes out the same each time the input is read.

    The key is the place of a row: its file, by a 64-bit hash of the path, and its number
    in the file as the Parquet reader counts it. How a scan is split, and so the number of
    cores and lost executors, doesn't matter. Rows that don't come straight from Parquet
    files are numbered as they are written once, and read from there with their numbers.
    """
    if _of_files(df):
        try:
            place = df.metadataColumn("_metadata")
            return df.withColumn(name, F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row")))
        except AnalysisException:  # a file source whose reader doesn't number its rows
            pass
    numbered = df.withColumn(name, F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row")))
    return Scratch(df.sparkSession, "rows").keep(numbered, "rows")


#: Keys of rows to take out are broadcast up to so many of about 100 bytes, else joined by shuffle.
BROADCAST_KEYS = 500_000


def without_rows(keyed: DataFrame, gone: DataFrame, name: str = "_row") -> DataFrame:
    """The rows of ``keyed``, with the key ``name``, whose key isn't among the ``_row`` of the written table ``gone``; while that is small, whole rows are not shuffled."""
    gone = gone.select(F.col("_row").alias(name))
    return keyed.join(F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone, name, "left_anti").drop(name)
