"""New files as a stream: each is worked on once, and a batch that is run again leaves the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from handbill.functions.jsons import strict_json
from handbill.functions.text import numeric_suffix
from handbill.sources.files import stem


def json_stream(spark: SparkSession, folder: str, glob: str = "*.json", files_a_batch: int = 1000) -> DataFrame:
    """(file_name, idx, body, v) of JSON files as they arrive."""
    source = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_a_batch)
    name = F.col("_metadata.file_name")
    return source.load(folder).select(name.alias("file_name"), numeric_suffix(stem(name)).alias("idx"), F.col("value").alias("body"), strict_json(F.col("value")).alias("v"))


def done_before(spark: SparkSession, out: str, key: str, batch: int) -> DataFrame | None:
    """Keys that other batches have written; None where nothing has been."""
    try:
        return spark.read.parquet(out).where(F.col("batch") != batch).select(key).distinct()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def incremental(stream: DataFrame, key: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Starts a query that writes transform(new rows) to out/batch=N and ends when all present files are done.

    Rows whose key an earlier batch wrote are skipped, so a lost checkpoint doesn't repeat work; transform must
    keep the key. A batch overwrites its own folder only, so one that failed half-way can run again.
    """

    def write(rows: DataFrame, batch: int) -> None:
        done = done_before(rows.sparkSession, out, key, batch)
        fresh = rows if done is None else rows.join(done, key, "left_anti")
        transform(fresh).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
