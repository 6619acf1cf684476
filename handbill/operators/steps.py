"""What each image of a folder still needs, and the steps that give it that."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handbill.functions.jsons import strict_json
from handbill.operators.blocks import build_blocks, prompt_blocks
from handbill.operators.layout import canvas
from handbill.operators.records import PROMPT, ask, fill_prompt, page_targets
from handbill.sources.files import annotation_items
from handbill.sources.storage import settled

SIDES = ("image", "annotation", "canvas", "target")


def image_steps(images: DataFrame, annotations: DataFrame, canvases: DataFrame, targets: DataFrame, skip_existing: bool = True) -> DataFrame:
    """(idx, step, read, render, aim) of listings (idx, ...): what each image still needs.

    One pass over all four listings by number, as a full outer join of them gives. Without an annotation an image is read and drawn
    (`all`), even if a canvas is there; with one but no canvas it is drawn (`render`); where both are there neither is done.
    Where there is no target one is asked for as well; `target` says that nothing else is needed, `nothing` that all is there. Without
    skip_existing every image needs everything. Listings that have no image are `orphan`; numbers that are null are left out.
    """
    each = [d.where("idx IS NOT NULL").select(F.col("idx").cast("bigint").alias("idx"), F.lit(s).alias("side")) for s, d in zip(SIDES, (images, annotations, canvases, targets), strict=True)]
    has = reduce(DataFrame.unionByName, each).groupBy("idx").agg(*[F.bool_or(F.col("side") == s).alias(s) for s in SIDES])
    there = F.lit(skip_existing)
    rows = has.withColumns({"read": F.col("image") & ~(there & F.col("annotation")), "aim": F.col("image") & ~(there & F.col("target"))})
    rows = rows.withColumn("render", F.col("image") & (F.col("read") | ~(there & F.col("canvas"))))
    step = F.when(~F.col("image"), "orphan").when(F.col("read"), "all").when(F.col("render"), "render").when(F.col("aim"), "target").otherwise("nothing")
    return rows.select("idx", step.alias("step"), "read", "render", "aim")


def take_steps(steps: DataFrame, images: DataFrame, annotations: DataFrame, reader: Callable[[str], str], provider: Callable[[str], str], template: str = PROMPT) -> DataFrame:
    """(idx, step, annotation, canvas, target, error) of steps as image_steps gives them: what is new, null where nothing had to be done.

    images(idx, path) that have to be read go to `reader`, a function from a path to the JSON text of its layout; those that have to be drawn and
    those without a target take their blocks from that or from annotations(idx, v). A failure in a step is its image's error, and ends
    its steps; others go on. Each step works on its share alone, and what was read or answered is written before it is used twice.
    """
    nothing = F.lit(None).cast("string")
    asked = steps.where("read").select("idx").join(images.select("idx", "path"), "idx")
    found = settled(ask(asked, "path", "annotation", reader).withColumn("v", strict_json(F.col("annotation"))))
    fault = F.coalesce("error", F.when(F.col("v").isNull(), F.lit("no JSON")))
    found = found.select("idx", "annotation", "v", fault.alias("error"))
    known = annotations.join(steps.where("NOT read AND (render OR aim)").select("idx"), "idx").select("idx", "v")
    pages = annotation_items(found.where("error IS NULL").select("idx", "v").unionByName(known))
    blocks = build_blocks(pages)
    prompts = prompt_blocks(blocks).withColumnRenamed("image", "idx")

    on_page = pages.select(F.col("image").alias("i"), "width", "height").distinct()
    share = blocks.join(steps.where("render").select(F.col("idx").alias("image")), "image").join(on_page, F.col("image") == F.col("i"))
    corner = [(F.get("box", F.lit(k)) * F.col(size) / 1000).alias(c) for k, (c, size) in enumerate((("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height")))]
    drawn = canvas(share.select("image", "place", "id", "text", *corner, "width", "height")).select(F.col("image").alias("idx"), F.col("svg").alias("canvas"))

    aims = steps.where("aim").select("idx").join(found.where("error IS NOT NULL").select("idx"), "idx", "left_anti")
    texts = aims.join(prompts, "idx", "left").select("idx", F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"), fill_prompt(F.coalesce("prompt", F.lit("[]")), template).alias("prompt"))
    aimed = settled(page_targets(texts, provider)).withColumnRenamed("error", "target_error")
    whole = steps.where("step <> 'orphan'").join(found.select("idx", "annotation", "error"), "idx", "left").join(drawn, "idx", "left").join(aimed, "idx", "left")
    kept = F.when(F.col("error").isNull(), F.col("annotation")).otherwise(nothing)
    return whole.select("idx", "step", kept.alias("annotation"), "canvas", "target", F.coalesce("error", "target_error").alias("error"))
