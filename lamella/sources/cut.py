"""The folder that executors share; cutting a plan where a table is used several times, or goes into the next step of a loop."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session (spark.checkpoint.dir).

    A local session without one gets a temporary folder; on a cluster its absence is an error.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lamella-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder that all executors share, and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
