"""Text blocks of a page, ready for a prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from handbill.functions.geometry import to_thousand
from handbill.functions.text import clean_text


def build_blocks(items: DataFrame, dense: bool = True, drop_labels: tuple[str, ...] = ()) -> DataFrame:
    """(image, id, text, box, order) of items(image, pos, text, x1, y1, x2, y2, order, width, height), in reading order.

    Items without text or with a box that isn't whole are left out. Ids count the items that are left
    (dense), or are their places among all. Blocks without an order come last, but where a column order_missing
    says that none was given the id is the order. Items whose label is one of drop_labels are left out first.
    """
    if drop_labels:
        items = items.where(~F.coalesce(F.col("label").isin(*drop_labels), F.lit(False)))
    box = F.array(*[to_thousand(F.col(c), F.col(s)) for c, s in (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))])
    kept = items.withColumn("text", clean_text(F.col("text"))).withColumn("box", box)
    kept = kept.where((F.col("text") != "") & F.forall("box", lambda x: x.isNotNull()))
    number = F.row_number().over(Window.partitionBy("image").orderBy("pos")) - 1 if dense else F.col("pos")
    placed = kept.withColumn("id", number.cast("bigint"))
    if "order_missing" in items.columns:
        placed = placed.withColumn("order", F.when(F.col("order_missing"), F.col("id")).otherwise(F.col("order")))
    reading = F.row_number().over(Window.partitionBy("image").orderBy(F.col("order").asc_nulls_last(), "id"))
    return placed.withColumn("place", reading.cast("bigint")).select("image", "place", "id", "text", "box", "order")


def prompt_blocks(blocks: DataFrame) -> DataFrame:
    """(image, n_blocks, prompt): each page's blocks as one JSON text, in reading order."""
    item = F.struct("place", F.struct(F.concat(F.lit("B"), F.col("id").cast("string")).alias("id"), "text", "order", F.col("box").alias("bbox_1000")).alias("block"))
    own = blocks.groupBy("image").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return own.select("image", F.size("items").cast("bigint").alias("n_blocks"), F.to_json(F.transform("items", lambda x: x["block"])).alias("prompt"))


def order_faults(blocks: DataFrame) -> DataFrame:
    """(image, error) of pages that a strict sort by order refuses: some block has none, and it isn't the only one."""
    own = blocks.groupBy("image").agg(F.count(F.lit(1)).alias("n"), F.count("order").alias("placed"))
    return own.where("n > 1 AND placed < n").select("image", F.lit("a block has no order to sort by").alias("error"))
