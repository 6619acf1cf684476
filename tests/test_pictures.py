"""Pictures of pages against loops over single pixels."""

import random

import numpy as np
import pytest

from handbill.operators import layout, pictures


def test_png_is_read_back():
    pixels = np.random.default_rng(1).integers(0, 256, (7, 13, 3)).astype(np.uint8)
    data = pictures.encode_png(pixels)
    assert (pictures.decode_png(data) == pixels).all()
    with pytest.raises(ValueError, match="IDAT"):
        pictures.decode_png(data[:60] + bytes([data[60] ^ 1]) + data[61:])


def over(pixels, x, y, colour, cover):
    if 0 <= y < len(pixels) and 0 <= x < len(pixels[0]):
        pixels[y][x] = [round((1 - cover) * p + cover * c) for p, c in zip(pixels[y][x], colour, strict=True)]


def test_boxes_against_single_pixels():
    r = random.Random(2)
    for _ in range(60):
        own = np.full((20, 30, 3), 255, np.uint8)
        plain = own.tolist()
        for _ in range(4):
            x1, y1 = r.randint(-5, 28), r.randint(-5, 18)
            x2, y2 = x1 + r.randint(0, 20), y1 + r.randint(0, 15)
            colour = tuple(r.randint(0, 255) for _ in range(3))
            if r.random() < 0.5:
                cover = r.choice([0.15, 0.5, 1.0])
                pictures.fill(own, x1, y1, x2, y2, colour, cover)
                for y in range(y1, y2 + 1):
                    for x in range(x1, x2 + 1):
                        over(plain, x, y, colour, cover)
            else:
                pictures.outline(own, x1, y1, x2, y2, colour)
                for y in range(y1, y2 + 1):
                    for x in range(x1, x2 + 1):
                        if min(x - x1, x2 - x, y - y1, y2 - y) < 3:
                            over(plain, x, y, colour, 1.0)
        assert own.tolist() == plain


def test_pages(spark):
    rows = [(1, 1, 0, "two words here", 10.0, 60.0, 200.0, 120.0, 300, 200), (1, 2, 1, "", 50.0, 100.0, 290.0, 190.0, 300, 200), (2, 1, 0, "x", 5.0, 5.0, 5.0, 50.0, 300, 200)]
    blocks = spark.createDataFrame(rows, "image long, place int, id int, text string, x1 double, y1 double, x2 double, y2 double, width int, height int")
    found = {r["image"]: pictures.decode_png(bytes(r["png"])) for r in pictures.pictures(blocks).collect()}
    assert set(found) == {1} and found[1].shape == (200, 300, 3)
    page = found[1]
    for r in layout.place_badges(layout.badge_size(layout.clamp_boxes(blocks))).collect():
        x1, y1, x2, y2 = r["badge"]
        assert tuple(page[y1, x1]) == pictures.BADGE and tuple(page[y2, x2]) == pictures.BADGE
        assert (page[y1 : y2 + 1, x1 : x2 + 1] == 255).all(axis=2).sum() > 20  # the label's dots
    assert tuple(page[60, 10]) == pictures.EDGE and tuple(page[199, 0]) == pictures.PAPER
    assert (page[62:90, 12:150] == pictures.INK).all(axis=2).sum() > 100
    assert tuple(page[150, 150]) not in (pictures.PAPER, pictures.EDGE)
    assert pictures.pictures(blocks.where("false")).count() == 0
