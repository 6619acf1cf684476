"""Helpers that the corpus operators share: session settings, shared storage, ranks, Arrow streams."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Java's spelling of the word pattern that every contract here uses.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in an Arrow batch: whole texts travel in them, so the default of 10,000 could hold gigabytes.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Lower Spark's default Arrow batch; a batch size that the session chose itself stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the folder that driver and executors share, which spark.checkpoint.dir names.

    Where that is unset, a fresh local folder serves a local master, as in tests; on a cluster it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="handbill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/handbill-{spark.sparkContext.applicationId}"


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


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors.

    Shuffle files of the job that writes go when it ends: what has been written needs them no more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def others(df: DataFrame, *names: str) -> list[str]:
    """df's columns but for those named like one of names: what passes through beside new columns of those names."""
    new = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in new]


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def partition_of(mid: Column) -> Column:
    """The partition in which monotonically_increasing_id() gave mid."""
    return F.shiftright(mid, 33)


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """df in the shared folder with `mid`, rising without gaps among the rows of one key in one partition."""
    return materialise(df.sortWithinPartitions(key).withColumn("mid", F.monotonically_increasing_id()), name)


def ranks(rows: DataFrame, key: str) -> DataFrame:
    """Gapless rank from 0 among the rows of each key, for what numbered() returns.

    Only counts for each partition and key are shuffled, so a key that holds most rows meets in no task.
    """
    pid = partition_of(F.col("mid"))
    counts = rows.groupBy(pid.alias("pid"), key).agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("first"))
    before = Window.partitionBy(key).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("pid", key, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        rows.withColumn("pid", pid)
        .join(base, ["pid", key])
        .withColumn("rank", F.col("base") + F.col("mid") - F.col("first"))
        .drop("pid", "first", "base", "mid")
    )


def arrow_map(df: DataFrame, schema: str | StructType, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], least_bytes: int = 0) -> DataFrame:
    """mapInArrow with a function made once for each task, which turns one batch into one batch.

    Batches of fewer than least_bytes go to it together with the next ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = None
        for batch in gathered(batches, least_bytes):
            each = each or make()
            out = each(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def gathered(batches: Iterator[pa.RecordBatch], least_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches in batches of least_bytes or more, but for the last; none is empty."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(x.nbytes for x in held) >= least_bytes:
                yield held[0] if len(held) == 1 else pa.concat_batches(held)
                held = []
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
