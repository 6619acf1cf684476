"""Pictures made of bands against pictures drawn pixel by pixel; texts fitted in batches against columns."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from handbill.operators import layout, pictures

R = random.Random(5)


def page(n, width, height):
    made = []
    for k in range(n):
        x1, y1 = R.randint(0, width - 2), R.randint(0, height - 2)
        size, lines = R.randint(8, 16), [" ".join("x" * R.randint(0, 9) for _ in range(6)) for _ in range(R.randint(0, 6))]
        badge = [R.randint(-9, width), R.randint(-9, height)]
        made.append({"place": R.randint(0, 2), "id": k, "x1": x1, "y1": y1, "x2": R.randint(x1 + 1, width - 1), "y2": R.randint(y1 + 1, height - 1), "size": size, "shown": R.choice([lines, lines, None]), "badge": [*badge, badge[0] + 30, badge[1] + 22]})
    return made


@pytest.mark.parametrize("width, height", [(300, 200), (41, 700), (3, 3)])
def test_bands_against_pixels(width, height):
    for n in (1, 2, 7, 20):
        blocks = page(n, width, height)
        pixels = np.full((height, width, 3), 255, np.uint8)
        for box, colour, cover in pictures.strokes(blocks):
            pictures.fill(pixels, *box, colour, cover)
        rows, times = pictures.bands(blocks, width, height)
        assert times.sum() == height and (np.repeat(rows, times, axis=0) == pixels).all()
        assert (pictures.decode_png(pictures.encode_bands(rows, times)) == pixels).all()


def test_large_pages_cost_their_edges():
    """Forty pages of 1920 by 1080 with five blocks: no page is drawn, or packed, pixel by pixel."""
    blocks = page(5, 1900, 1000)
    began = time.process_time()
    for _ in range(40):
        data = pictures.encode_bands(*pictures.bands(blocks, 1920, 1080))
    assert time.process_time() - began < 1.5
    assert pictures.decode_png(data).shape == (1080, 1920, 3)


def test_repeated_rows_of_all_numbers():
    rows = np.random.default_rng(3).integers(0, 256, (9, 5, 3)).astype(np.uint8)
    for times in ([1] * 9, [1, 2, 3, 4, 5, 63, 64, 100, 1080], [1080, 1, 1, 7, 1, 1, 1, 1, 1]):
        data = pictures.encode_bands(rows, np.array(times))
        assert (pictures.decode_png(data) == np.repeat(rows, times, axis=0)).all()


def test_fitted_against_columns(spark):
    texts = ["", " ", "one", "a\n\nb", "tab\tand\x0bmore\n", "no\xa0break", "x" * 80, "é東 京 " * 9, None]
    texts += [" ".join("x" * R.randint(1, 14) for _ in range(R.randint(1, 90))) + R.choice(["", "\nlast line"]) for _ in range(60)]
    rows = spark.createDataFrame([(t, R.choice([20, 47, 60, 131, 420]), R.choice([10, 40, 160, 400])) for t in texts], "text string, wide int, high int")
    inner = [F.greatest(F.lit(8), F.col(c) - 2 * layout.PAD).cast("double") for c in ("wide", "high")]
    both = rows.select("text", layout.fit(F.col("text"), F.col("wide"), F.col("high")).alias("a"), layout.fit_plain("text", *inner).alias("b")).collect()
    assert len(both) == 69 and all(r.a["lines"] == r.b["lines"] and (r.text is None or r.a["size"] == r.b["size"]) for r in both)


def test_pages_are_dealt_to_all_partitions(spark):
    """Adaptive execution merges partitions of few bytes: drawing must not end up in one task."""
    rows = [(k, 0, 0, "two words", 10.0, 60.0, 200.0, 120.0, 300, 200) for k in range(60)]
    blocks = spark.createDataFrame(rows, "image long, place int, id int, text string, x1 double, y1 double, x2 double, y2 double, width int, height int")
    tasks = pictures.pictures(blocks).select("image", F.spark_partition_id().alias("task")).collect()
    assert len(tasks) == 60 and len({r.task for r in tasks}) > 1
