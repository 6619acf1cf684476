"""Layout of a page's blocks: clamped rectangles, wrapped and fitted text, badges, and an SVG canvas.

Text is measured by the widths of a font file where one is named, else by a fixed width a character (CHAR of the font size). A page's
blocks are collected; a page is small by nature.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handbill.functions.fonts import fit_font
from handbill.functions.geometry import overlap

# Font sizes, margins and gaps in pixels.
LARGEST, SMALLEST, PAD, GAP = 16, 8, 6, 3
BADGE_FONT, BADGE_PAD_X, BADGE_PAD_Y, BADGE_GAP = 14, 8, 4, 2
# Width of a character and height of a line, as shares of the font size.
CHAR, LINE = 0.6, 1.0
NO_TEXT = "array<string>"
#: White space between words.
SPLIT = re.compile(r"[ \t\n\x0b\f\r]+")


def text_width(text: Column, size: Column) -> Column:
    return F.length(text) * size * CHAR


def wrap(text: Column, size: Column, width: Column) -> Column:
    """Lines of a text, broken greedily between words; line breaks stay, a word too long stands alone."""

    def add(state: Column, word: Column) -> Column:
        longer = F.concat(state["now"], F.lit(" "), word)
        return (
            F.when(state["now"].isNull(), F.struct(state["lines"].alias("lines"), word.alias("now")))
            .when(text_width(longer, size) <= width, F.struct(state["lines"].alias("lines"), longer.alias("now")))
            .otherwise(F.struct(F.concat(state["lines"], F.array(state["now"])).alias("lines"), word.alias("now")))
        )

    def paragraph(p: Column) -> Column:
        words = F.filter(F.split(p, r"\s+"), lambda x: x != "")
        start = F.struct(F.array().cast(NO_TEXT).alias("lines"), F.lit(None).cast("string").alias("now"))
        return F.aggregate(words, start, add, lambda s: F.concat(s["lines"], F.array(F.coalesce(s["now"], F.lit("")))))

    return F.flatten(F.transform(F.split(text, "\n"), paragraph))


def fit(text: Column, width: Column, height: Column) -> Column:
    """struct(size, lines) in the largest font whose lines fit a box, else in the smallest."""
    inner_w, inner_h = F.greatest(F.lit(8), width - 2 * PAD), F.greatest(F.lit(8), height - 2 * PAD)
    tried = F.transform(F.sequence(F.lit(LARGEST), F.lit(SMALLEST), F.lit(-1)), lambda s: F.struct(s.alias("size"), wrap(text, s, inner_w).alias("lines")))
    fits = F.filter(tried, lambda t: F.size(t["lines"]) * (t["size"] * LINE + GAP) - GAP <= inner_h)
    return F.coalesce(F.get(fits, F.lit(0)), F.element_at(tried, -1))


def wrapped(words: list[list[str]], most: int) -> list[list[str]]:
    """Lines, as words, of paragraphs of words, broken greedily where a line would have over `most` characters; a word too long stands alone."""
    lines = []
    for paragraph in words:
        line, used = [], -1
        for word in paragraph:
            if line and used + 1 + len(word) > most:
                lines.append(line)
                line, used = [], -1
            line.append(word)
            used += 1 + len(word)
        lines.append(line)
    return lines


def fitted(text: str | None, width: float, height: float) -> tuple[int, list[str] | None]:
    """Size and lines in the largest font whose lines fit, else in the smallest. A larger font never needs fewer lines, so what fits is found by halving."""
    if text is None:
        return SMALLEST, None
    words = [[x for x in SPLIT.split(p) if x] for p in text.split("\n")]
    low, high, best = SMALLEST, LARGEST, None
    while low <= high:
        size = (low + high + 1) // 2
        most = int(width / (size * CHAR)) + 2
        while most and most * size * CHAR > width:
            most -= 1
        lines = wrapped(words, most)
        if len(lines) * (size * LINE + GAP) - GAP <= height:
            best, low = (size, lines), size + 1
        else:
            best, high = best or ((size, lines) if size == SMALLEST else None), size - 1
    return best[0], [" ".join(x) for x in best[1]]


@F.pandas_udf(T.StructType().add("size", T.IntegerType()).add("lines", T.ArrayType(T.StringType())))
def fit_plain(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """fit() of a text and the insides of a box, for whole batches: columns break a text anew for each size, word by word."""
    for batch in batches:
        rows = [fitted(*row) for row in zip(*batch, strict=True)]
        yield pd.DataFrame({"size": [r[0] for r in rows], "lines": [r[1] for r in rows]})


def clamp_boxes(blocks: DataFrame) -> DataFrame:
    """blocks(x1, y1, x2, y2, width, height, ...) in whole pixels on the page; boxes without an area are left out."""

    def whole(c: str, size: str) -> Column:
        return F.greatest(F.lit(0), F.least(F.col(size) - 1, F.rint(c))).cast("int").alias(c)

    rest = [c for c in blocks.columns if c not in ("x1", "y1", "x2", "y2")]
    on_page = blocks.select(*rest, whole("x1", "width"), whole("y1", "height"), whole("x2", "width"), whole("y2", "height"))
    return on_page.where("x2 > x1 AND y2 > y1")


def place_badges(boxes: DataFrame) -> DataFrame:
    """(image, id, badge) of boxes(image, place, id, x1, y1, x2, y2, width, height, badge_w, badge_h), in order of place.

    Of six places the first on the page that meets no earlier badge; if there is none, inside the box's corner and on the page.
    """
    columns = ("x1", "y1", "x2", "y2", "width", "height", "badge_w", "badge_h")
    item = F.struct("place", F.col("id").cast("bigint").alias("id"), *[F.col(c).cast("int").alias(c) for c in columns])
    pages = boxes.groupBy("image").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def chosen(taken: Column, b: Column) -> Column:
        w, h, g = b["badge_w"], b["badge_h"], BADGE_GAP
        above, under, left, right = b["y1"] - h - g, b["y2"] + g, b["x1"], b["x2"] - w
        corners = [(left, above), (right, above), (left + g, b["y1"] + g), (right - g, b["y1"] + g), (left, under), (right, under)]
        tried = F.array(*[F.array(x, y, x + w, y + h) for x, y in corners])
        free = F.filter(tried, lambda c: (c[0] >= 0) & (c[1] >= 0) & (c[2] <= b["width"]) & (c[3] <= b["height"]) & ~F.exists(taken, lambda t: overlap(c, t["badge"])))
        x, y = F.greatest(F.lit(0), F.least(b["width"] - w, left + g)), F.greatest(F.lit(0), F.least(b["height"] - h, b["y1"] + g))
        return F.coalesce(F.get(free, F.lit(0)), F.array(x, y, x + w, y + h))

    none = F.array().cast("array<struct<id:bigint,badge:array<int>>>")
    placed = F.aggregate("items", none, lambda taken, b: F.concat(taken, F.array(F.struct(b["id"].alias("id"), chosen(taken, b).alias("badge")))))
    return pages.select("image", F.explode(placed).alias("p")).select("image", "p.id", "p.badge")


def badge_size(boxes: DataFrame) -> DataFrame:
    """boxes with badge_w and badge_h for the label B and the id."""
    label = F.concat(F.lit("B"), F.col("id").cast("string"))
    wide = F.ceil(text_width(label, F.lit(BADGE_FONT))) + BADGE_PAD_X
    return boxes.withColumn("badge_w", wide.cast("int")).withColumn("badge_h", F.lit(round(BADGE_FONT * LINE) + BADGE_PAD_Y))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def laid_out(blocks: DataFrame, font: str | None = None) -> DataFrame:
    """blocks(image, place, id, text, x1, y1, x2, y2, width, height) on the page: size and `shown`, the lines that fit, and badge.

    font: path of a font file by whose widths texts are wrapped and fitted.
    """
    wide, high = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    fitting = fit_plain if font is None else fit_font(font, (SMALLEST, LARGEST), LINE, GAP)
    fit_ = fitting("text", *[F.greatest(F.lit(8), x - 2 * PAD).cast("double") for x in (wide, high)])
    boxes = badge_size(clamp_boxes(blocks)).withColumn("fit", fit_)
    both = boxes.join(place_badges(boxes), ["image", "id"]).withColumn("size", F.col("fit.size"))
    step = F.col("size") * LINE + GAP
    return both.withColumn("shown", F.filter("fit.lines", lambda line, i: F.col("y1") + PAD + i * step + F.col("size") * LINE <= F.col("y2") - 4)).drop("fit")


def canvas(blocks: DataFrame, font: str | None = None) -> DataFrame:
    """(image, svg) of blocks as laid_out() takes them: outlines, texts as far as they fit, badges on top."""
    both = laid_out(blocks, font)
    size = F.col("size")
    step = size * LINE + GAP
    shown = F.col("shown")
    lines = F.transform(shown, lambda line, i: F.format_string('<text x="%d" y="%d" font-size="%d">%s</text>', F.col("x1") + PAD, (F.col("y1") + PAD + (i + 1) * step - GAP).cast("int"), size, escaped(line)))
    outline = F.format_string('<rect x="%d" y="%d" width="%d" height="%d" fill="none" stroke="black" stroke-width="3"/>', "x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    badge = F.format_string('<rect x="%d" y="%d" width="%d" height="%d"/><text x="%d" y="%d" fill="white">B%d</text>', F.get("badge", F.lit(0)), F.get("badge", F.lit(1)), "badge_w", "badge_h", F.get("badge", F.lit(0)) + 4, F.get("badge", F.lit(3)) - 3, "id")
    drawn = both.select("image", "width", "height", F.struct("place", F.concat(outline, F.array_join(lines, "")).alias("body"), badge.alias("badge")).alias("b"))
    pages = drawn.groupBy("image").agg(F.max("width").cast("int").alias("w"), F.max("height").cast("int").alias("h"), F.array_sort(F.collect_list("b")).alias("all"))
    head = F.format_string('<svg xmlns="http://www.w3.org/2000/svg" width="%d" height="%d">', "w", "h")
    parts = [F.array_join(F.transform("all", lambda x: x[name]), "") for name in ("body", "badge")]  # noqa: B023
    return pages.select("image", F.concat(head, parts[0], parts[1], F.lit("</svg>")).alias("svg"))
