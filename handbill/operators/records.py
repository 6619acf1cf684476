"""Final records and training samples: what a model is asked, and what is made of its answers.

Models are providers: a function from a prompt to a text, called in the tasks. Prompts are parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handbill.functions import datetimes
from handbill.functions.geometry import data_url
from handbill.functions.jsons import events_of, extract_any, kind
from handbill.functions.schema import ensure_schema
from handbill.functions.text import NOVALUE, bound
from handbill.sources.storage import settled

#: Stands for the blocks in a prompt.
SLOT = "{blocks}"
PROMPT = "List the events on this page as a JSON array of objects. Copy texts as they stand. Blocks, in reading order:\n{blocks}"
#: Templates by what a model is asked for: texts as they stand, what is printed before what is known, and that with dates in ISO form.
PROMPTS = {
    "copied": PROMPT,
    "printed": "The page is the only source: where it contradicts what you know, it is right.\n" + PROMPT,
    "dated": "The page is the only source: where it contradicts what you know, it is right. Write dates as YYYY-MM-DD; a date without a year is the next to come.\n" + PROMPT,
}
REPAIR = "Write this again as a valid JSON array and nothing else:\n"


def fill_prompt(blocks_json: Column, template: str = PROMPT) -> Column:
    """A template with a page's blocks in its slot."""
    before, _, after = template.partition(SLOT)
    return F.concat(F.lit(before), blocks_json, F.lit(after))


def normalize_when(events: DataFrame, today: date) -> DataFrame:
    """events(source, pos, date, time, event_name, venue, ...) with start_date, start_time, end_date, end_time.

    A date without a year takes the first year named in its file, in order of events, then date, name and venue. ISO dates and
    plain ones (month, day, year) never reach the parser; each other distinct text and hint is parsed once. An end date is the start date.
    """
    years = F.array(*[F.struct(datetimes.year_hint(F.col(c)).alias("year")) for c in ("date", "event_name", "venue")])
    named = events.select("source", "pos", F.posexplode(years).alias("k", "y")).where("y.year IS NOT NULL")
    hints = named.groupBy("source").agg(F.min_by("y.year", F.struct("pos", "k")).alias("file_year"))
    own = datetimes.year_hint(F.col("date"))
    rows = events.join(hints, "source", "left").withColumn("hint", F.coalesce(own, "file_year"))
    rows = rows.withColumn("iso", F.coalesce(datetimes.iso_date(F.col("date")), datetimes.plain_date(F.col("date"), F.col("hint"), today)))
    texts = rows.where("iso IS NULL AND date IS NOT NULL").select(F.col("date").alias("d"), F.col("hint").alias("h")).distinct()
    parsed = texts.withColumn("parsed", datetimes.free_date(today)("d", "h"))
    found = rows.join(parsed, (F.col("date") == F.col("d")) & F.col("hint").eqNullSafe(F.col("h")), "left")
    start = F.coalesce("iso", "parsed", F.lit(NOVALUE))
    dated = datetimes.with_times(found.select(*events.columns, start.alias("start_date")))
    return dated.select(*events.columns, "start_date", "start_time", F.col("start_date").alias("end_date"), "end_time")


def ask(rows: DataFrame, prompt: str, answer: str, provider: Callable[[str], str]) -> DataFrame:
    """rows with the provider's answer to the prompt column, and `error` where it failed; other rows go on."""
    from pyspark.sql.types import StringType, StructType

    schema = StructType([*rows.schema.fields]).add(answer, StringType()).add("error", StringType())

    def one(text: str) -> tuple[str | None, str | None]:
        try:
            return provider(text), None
        except Exception as failure:  # noqa: BLE001 - whatever a model client raises becomes this row's error
            return None, f"{type(failure).__name__}: {failure}"

    def answered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [one(t) for t in batch[prompt]]
            yield batch.assign(**{answer: [m[0] for m in made], "error": [m[1] for m in made]})

    return rows.mapInPandas(answered, schema)


def first_record(found: Column) -> Column:
    """The fixed record of the first object in a list that an answer holds; an empty one where the list is empty; null where there is no list."""
    def whole(listed: Column) -> Column:
        return bound(F.get(listed, F.lit(0)), lambda x: F.when(kind(x) == "object", x).otherwise(F.parse_json(F.lit("{}"))))

    return bound(F.try_variant_get(found, "$", "array<variant>"), lambda x: F.when(x.isNotNull(), ensure_schema(whole(x))))


def merge_records(asked: DataFrame, provider: Callable[[str], str]) -> DataFrame:
    """asked(key columns..., prompt) with record and error: answers without JSON are sent back once to be mended.

    Answers are written, parsed, before they are read twice, so no prompt is sent again for that and none is parsed again.
    """
    keys = [c for c in asked.columns if c != "prompt"]

    def parsed(answered: DataFrame) -> DataFrame:
        return answered.select(*keys, "answer", "error", extract_any(F.col("answer")).alias("found"))

    answers = settled(parsed(ask(asked, "prompt", "answer", provider)))
    done = F.col("found").isNotNull() | F.col("error").isNotNull()
    mended = answers.where(~done).select(*keys, F.concat(F.lit(REPAIR), "answer").alias("prompt"))
    both = answers.where(done).unionByName(parsed(ask(mended, "prompt", "answer", provider)))
    made = both.select(*keys, "error", first_record(F.col("found")).alias("record"))
    return made.select(*keys, "record", F.coalesce("error", F.when(F.col("record").isNull(), F.lit("no JSON array"))).alias("error"))


def normalize_target(v: Column) -> Column:
    """A target as JSON text {"events": [...]}, from an object with such a list or from a bare list; else null."""
    listed = events_of(v)
    return F.when(listed.isNotNull(), F.to_json(F.struct(listed.alias("events"))))


def training_samples(images: DataFrame, canvases: DataFrame, prompts: DataFrame, targets: DataFrame, template: str = PROMPT) -> DataFrame:
    """(idx, messages, missing) of images(idx, path), canvases(idx, path), prompts(idx, prompt) and targets(idx, v).

    One row for each image with a number; messages is null where a side is missing or a target is no list, and
    missing says which.
    """
    sides = images.where("idx IS NOT NULL").select("idx", F.col("path").alias("image"))
    sides = sides.join(canvases.select("idx", F.col("path").alias("canvas")), "idx", "left").join(prompts.select("idx", "prompt"), "idx", "left")
    sides = sides.join(targets.select("idx", normalize_target(F.col("v")).alias("target")), "idx", "left")
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(n)) for c, n in (("canvas", "canvas"), ("prompt", "annotation"), ("target", "target"))]))

    def part(kind_: str, image: str | None, text: Column | None) -> Column:
        nothing = F.lit(None).cast("string")
        return F.struct(F.lit(kind_).alias("type"), (F.col(image) if image else nothing).alias("image"), (nothing if text is None else text).alias("text"))

    user = F.array(part("image", "image", None), part("image", "canvas", None), part("text", None, fill_prompt(F.col("prompt"), template)))
    turns = F.array(F.struct(F.lit("user").alias("role"), user.alias("content")), F.struct(F.lit("assistant").alias("role"), F.array(part("text", None, F.col("target"))).alias("content")))
    return sides.select("idx", F.when(F.size(missing) == 0, turns).alias("messages"), missing.alias("missing"))


def vision_messages(images: DataFrame, canvases: DataFrame, prompts: DataFrame, template: str = PROMPT) -> DataFrame:
    """(idx, messages) of images(idx, content), canvases(idx, content) and prompts(idx, prompt) that have all three.

    One user turn: both images as data URLs in high detail, then the filled prompt.
    """
    nothing = F.lit(None).cast("struct<url: string, detail: string>")

    def image(content: str):
        url = F.struct(data_url(F.col(content)).alias("url"), F.lit("high").alias("detail"))
        return F.struct(F.lit("image_url").alias("type"), url.alias("image_url"), F.lit(None).cast("string").alias("text"))

    rows = images.select("idx", F.col("content").alias("image")).join(canvases.select("idx", F.col("content").alias("canvas")), "idx").join(prompts.select("idx", "prompt"), "idx")
    text = F.struct(F.lit("text").alias("type"), nothing.alias("image_url"), fill_prompt(F.col("prompt"), template).alias("text"))
    return rows.select("idx", F.array(F.struct(F.lit("user").alias("role"), F.array(image("image"), image("canvas"), text).alias("content"))).alias("messages"))


def page_targets(pages: DataFrame, provider: Callable[[str], str]) -> DataFrame:
    """(idx, target, error) of pages(idx, n_blocks, prompt): what the provider answers, as JSON text {"events": [...]}.

    A page without blocks has no events and isn't asked about; an answer without a list of events has none either.
    """
    empty = F.lit('{"events":[]}')
    bare = pages.where(F.coalesce("n_blocks", F.lit(0)) == 0).select("idx", empty.alias("target"), F.lit(None).cast("string").alias("error"))
    asked = ask(pages.where("n_blocks > 0").select("idx", "prompt"), "prompt", "answer", provider)
    found = F.coalesce(normalize_target(extract_any(F.col("answer"))), F.when(F.col("error").isNull(), empty))
    return asked.select("idx", found.alias("target"), "error").unionByName(bare)


def prediction_records(images: DataFrame, canvases: DataFrame, annotations: DataFrame, targets: DataFrame, faults: DataFrame, provider: Callable[[str], str]) -> DataFrame:
    """(idx, error, record) of images(idx, path): the record, as JSON text, that a run leaves for each image.

    canvases(idx, path) and annotations(idx, path, n_blocks, prompt) are required, targets(idx, v) are taken along where there
    are any. A missing side, a page that faults(idx, error) names or a failing provider gives an error record in the prediction's
    place; only complete pages are asked about.
    """
    sides = images.where("idx IS NOT NULL").select("idx", F.col("path").alias("image"))
    sides = sides.join(canvases.select("idx", F.col("path").alias("canvas")), "idx", "left")
    sides = sides.join(annotations.select("idx", F.col("path").alias("annotation"), "n_blocks", "prompt"), "idx", "left")
    sides = sides.join(faults.select("idx", F.col("error").alias("fault")), "idx", "left").join(targets.select("idx", F.to_json("v").alias("target")), "idx", "left")
    gone = F.array_join(F.array(F.when(F.col("canvas").isNull(), F.lit("canvas")), F.when(F.col("annotation").isNull(), F.lit("annotation"))), ", ")
    sides = sides.withColumn("fault", F.coalesce(F.when(gone != "", F.concat(F.lit("missing files: "), gone)), "fault"))
    nothing = F.lit(None).cast("string")
    whole = ask(sides.where("fault IS NULL").drop("fault"), "prompt", "raw_output", provider)
    both = whole.unionByName(sides.where("fault IS NOT NULL").withColumn("raw_output", nothing).withColumnRenamed("fault", "error"))
    where = [F.col("idx").alias("index"), "image", "canvas", "annotation"]
    found = F.struct(*where, F.col("n_blocks").alias("num_blocks"), extract_any(F.col("raw_output")).alias("prediction"), "raw_output", F.try_parse_json("target").alias("target"))
    failed = F.struct(*where, "error")
    return both.select("idx", "error", F.when(F.col("error").isNull(), F.to_json(found)).otherwise(F.to_json(failed)).alias("record"))
