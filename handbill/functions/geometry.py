"""Boxes, polygons, image sizes and frame numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_thousand(value: Column, size: Column) -> Column:
    """A coordinate on a scale of 0 to 1000, rounded half to even; null without a size."""
    scaled = F.rint(F.try_divide(F.lit(1000) * value, size))
    return F.when(scaled.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(1000), scaled))).cast("int")


def box_of(polygon: Column) -> Column:
    """[left, top, right, bottom] of an array of [x, y]."""
    x, y = F.transform(polygon, lambda p: F.get(p, F.lit(0))), F.transform(polygon, lambda p: F.get(p, F.lit(1)))
    return F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y))


def overlap(a: Column, b: Column) -> Column:
    """Whether two boxes meet, edges included."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def png_size(content: Column) -> Column:
    """struct(width, height) from the fixed places of a PNG's first chunk."""
    width, height = (F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int") for at in (17, 21))
    return F.struct(width.alias("width"), height.alias("height"))


def data_url(content: Column) -> Column:
    """A PNG as a data URL; base64() breaks lines unless the session forbids it, so breaks are taken out."""
    return F.concat(F.lit("data:image/png;base64,"), F.translate(F.base64(content), "\r\n", ""))


def frame_step(seconds: float) -> int:
    return max(1, round(seconds))


def sample_plan(videos, seconds: float, max_seconds: int = 0):
    """(video columns, sec, frame) of every second at which a video(total, fps) is sampled."""
    fps = F.when(F.col("fps") > 0, F.col("fps")).otherwise(F.lit(30.0))
    length = F.floor(F.col("total") / fps)
    length = F.least(length, F.lit(max_seconds)) if max_seconds > 0 else length
    at = videos.withColumn("sec", F.explode(F.sequence(F.lit(0), length.cast("int"), F.lit(frame_step(seconds)))))
    return at.withColumn("frame", F.greatest(F.lit(0), F.least(F.col("total") - 1, F.rint(F.col("sec") * fps))).cast("bigint"))
