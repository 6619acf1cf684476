"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. A local folder stands in where that is unset, under a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="handbill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder, which whoever owns it may clear with the application."""
    return f"{shared_folder(spark)}/handbill-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df checkpointed to the shared folder: later steps start from there, on lost executors too."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots as two underscores) that hold inside the block only."""
    before = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k.replace("__", "."), v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
