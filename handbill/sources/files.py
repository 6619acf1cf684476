"""Files of a run as rows: images, whole JSON texts, predictions, annotations.

Nothing is inferred: JSON stays one text and one variant a file, so that a stray file can't change a schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from handbill.functions.geometry import box_of, png_size
from handbill.functions.jsons import kind, strict_json
from handbill.functions.schema import plain_text
from handbill.functions.text import bound, coerce, numeric_suffix

FIELDS = ("event_name", "venue", "date", "time", "recurring")
STEM = r"\.[^.]*$"


def stem(name: Column) -> Column:
    return F.regexp_replace(name, STEM, "")


def images(spark: SparkSession, folder: str, glob: str = "out*.png", only: int | None = None) -> DataFrame:
    """(idx, path, content) of image files, or of the one of a number; idx is null where a name ends in no number.

    Unread columns are not loaded.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    found = files.select(numeric_suffix(stem(F.element_at(F.split("path", "/"), -1))).alias("idx"), "path", "content")
    return found if only is None else found.where(F.col("idx") == only)


def in_order(rows: DataFrame, missing_last: bool = False) -> DataFrame:
    """rows(idx, path, ...) by number, then path; those without a number first, or last."""
    return rows.orderBy(F.col("idx").asc_nulls_last() if missing_last else F.col("idx").asc_nulls_first(), "path")


def required(rows: DataFrame, what: str) -> DataFrame:
    """rows, of which there has to be one: FileNotFoundError where there is none."""
    if rows.isEmpty():
        raise FileNotFoundError(f"no {what}")
    return rows


def without_existing(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """rows whose key no row of done has: what a run that skips existing results still has to do."""
    return rows.join(done.select(key), key, "left_anti")


def first_in_stride(rows: DataFrame, by: list[str], time: Column, number: str, seconds: int) -> DataFrame:
    """(by, bucket, first, n): of each stretch of `seconds` the number of the earliest row (ties: the least), and how many rows."""
    bucket = F.floor(F.unix_timestamp(time) / seconds).cast("bigint")
    own = rows.withColumn("bucket", bucket).groupBy(*by, "bucket")
    return own.agg(F.min(F.struct(time.alias("time"), F.col(number).alias("number")))["number"].alias("first"), F.count(F.lit(1)).alias("n"))


def zip_positional(a: Column, b: Column, names: tuple[str, str]) -> Column:
    """Two arrays side by side as structs, as many as both have; null where one is null."""
    both = F.least(F.size(a), F.size(b))
    zipped = F.arrays_zip(F.slice(a, 1, both).alias(names[0]), F.slice(b, 1, both).alias(names[1]))
    return F.when(a.isNotNull() & b.isNotNull(), zipped)


def json_files(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """(file_name, idx, body, v) of JSON files; v is null where the text is not one JSON value."""
    files = spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True)
    name = F.col("_metadata.file_name")
    return files.select(name.alias("file_name"), numeric_suffix(stem(name)).alias("idx"), F.col("value").alias("body"), strict_json(F.col("value")).alias("v"))


def predictions(spark: SparkSession, folder: str, glob: str = "prediction*.json") -> DataFrame:
    return json_files(spark, folder, glob)


def loose_text(v: Column) -> Column:
    """A scalar as text, null where it is missing or null: strings stripped (null if blank), other values as plain_text() has them."""
    def text(x: Column) -> Column:
        return F.when(kind(x) == "string", coerce(F.try_variant_get(x, "$", "string"))).otherwise(plain_text(x))

    return bound(v, text)


def prediction_events(files: DataFrame) -> DataFrame:
    """(source, pos, ordinal, the five fields) of every object under prediction.events of files(file_name, v).

    Ordinals follow file names by code point, then places; files without such a list give no rows.
    """
    inside = F.try_variant_get("v", "$.prediction.events", "array<variant>")
    rows = files.select(F.col("file_name").alias("source"), F.posexplode(inside).alias("pos", "e")).where(kind(F.col("e")) == "object")
    fields = [loose_text(F.try_variant_get("e", f"$.{f}", "variant")).alias(f) for f in FIELDS]
    return rows.select("source", "pos", F.struct("source", "pos").alias("ordinal"), *fields)


def numbered(events: DataFrame, run: Column) -> DataFrame:
    """prediction_events as one run each: run_id, and a dense ordinal in it. A run is what one source yields, small by nature."""
    order = F.row_number().over(Window.partitionBy("run_id").orderBy("source", "pos")) - 1
    return events.withColumn("run_id", run).withColumn("ordinal", order.cast("bigint"))


def run_summary(files: DataFrame, events: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: files in order of names (those without events too), events before and after merging."""
    names = files.agg(F.array_sort(F.collect_set("file_name")).alias("sources"))
    return names.crossJoin(events.agg(F.count(F.lit(1)).alias("n_input"))).crossJoin(merged.agg(F.count(F.lit(1)).alias("n_output")))


def sampled_seconds(v: Column) -> Column:
    """The seconds in a sampling log, under the present key or the former one; else none."""
    now, former = (F.try_variant_get(v, f"$.{k}", "array<int>") for k in ("sampled_secs", "trigger_secs"))
    return F.coalesce(now, former, F.array().cast("array<int>"))


def four_numbers(v: Column) -> Column:
    """An array of four numbers, or null."""
    parts = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "double"))
    return F.when((F.size(parts) == 4) & F.forall(parts, lambda x: x.isNotNull()), parts)


def annotation_items(annotations: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Items of annotations(idx, v), as operators.blocks takes them.

    The structured list counts if it is a list, even an empty one; else texts and boxes side by side, as many as both
    have. `order_missing` tells an order that is not given from one that is null. Where a width or height is missing or
    zero, both come from sizes(idx, content) of PNGs.
    """
    def own(x: Column) -> Column:
        poly = box_of(F.try_variant_get(x, "$.block_poly", "array<array<double>>"))
        given = F.try_variant_get(x, "$.block_bbox", "variant")
        box = F.when(given.isNull() | (kind(given) == "void"), F.when(F.forall(poly, lambda c: c.isNotNull()), poly)).otherwise(four_numbers(given))
        order = F.try_variant_get(x, "$.block_order", "variant")
        content = F.try_variant_get(x, "$.block_content", "variant")
        return F.struct(
            F.when(kind(content) == "string", F.try_variant_get(content, "$", "string")).alias("text"), box.alias("box"),
            F.try_variant_get(order, "$", "bigint").alias("order"), order.isNull().alias("order_missing"),
            F.try_variant_get(x, "$.block_label", "string").alias("label"),
        )

    def flat(x: Column) -> Column:
        return F.struct(F.try_variant_get(x["t"], "$", "string").alias("text"), four_numbers(x["b"]).alias("box"), F.lit(None).cast("bigint").alias("order"), F.lit(True).alias("order_missing"), F.lit(None).cast("string").alias("label"))

    listed = F.try_variant_get("v", "$.parsing_res_list", "array<variant>")
    texts, boxes = (F.try_variant_get("v", f"$.{k}", "array<variant>") for k in ("rec_texts", "rec_boxes"))
    structured = kind(F.try_variant_get("v", "$.parsing_res_list", "variant")) == "array"
    items = F.when(structured, F.transform(listed, own)).otherwise(F.transform(zip_positional(texts, boxes, ("t", "b")), flat))
    width, height = (F.try_variant_get("v", f"$.{k}", "double") for k in ("width", "height"))
    pages = annotations.select("idx", width.alias("width"), height.alias("height"), items.alias("items"))
    if sizes is not None:
        probed = sizes.select("idx", png_size(F.col("content")).alias("png"))
        lacks = F.coalesce(F.col("width"), F.lit(0.0)) * F.coalesce(F.col("height"), F.lit(0.0)) == 0
        pages = pages.join(probed, "idx", "left").withColumn("lacks", lacks)
        pages = pages.select("idx", *[F.when(F.col("lacks"), F.col("png")[s].cast("double")).otherwise(F.col(s)).alias(s) for s in ("width", "height")], "items")
    rows = pages.select(F.col("idx").alias("image"), "width", "height", F.posexplode("items").alias("pos", "i"))
    corner = [F.get("i.box", F.lit(k)).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))]
    return rows.select("image", "pos", "i.text", *corner, "i.order", "i.order_missing", "i.label", "width", "height")
