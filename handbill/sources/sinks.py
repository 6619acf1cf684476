"""Results as files of pretty JSON, each under its own name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handbill.sources.named import write_named


def pretty(value: Column) -> Column:
    """Indented JSON; characters beyond ASCII stay as they are."""
    return F.to_json(value, {"pretty": "true"})


def write_json(df: DataFrame, folder: str, name: Column, value: Column) -> None:
    """One file of pretty JSON for each row, under its name; files of other names are left alone. See named.write_named."""
    write_named(df.select(name.alias("name"), pretty(value).alias("body")), folder)


def result_name(source: Column, prefix: str) -> Column:
    """A prediction file's name with `prediction` replaced: enriched_ or dryrun_."""
    return F.replace(source, F.lit("prediction"), F.lit(prefix))


def per_file(events: DataFrame, files: DataFrame, prefix: str, item: Column) -> DataFrame:
    """(file_name, items): each file's items in order of place, an empty list where it has none."""
    own = events.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("pos", item.alias("item")))).alias("all"))
    kept = own.select(F.col("source").alias("file_name"), F.transform("all", lambda x: x["item"]).alias("items"))
    whole = files.select("file_name").join(kept, "file_name", "left")
    return whole.select(result_name(F.col("file_name"), prefix).alias("file_name"), F.coalesce("items", F.array()).alias("items"))
