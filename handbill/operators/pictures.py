"""Canvases as PNG pictures: boxes, outlines, lines of text, badges, drawn once for each stretch in which nothing changes."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handbill.operators.layout import CHAR, GAP, LINE, PAD, laid_out

# Colours of paper, a box's fill and outline, text, badges and their labels; how strongly fills cover; pixels of an outline.
PAPER, FILL, EDGE, INK, BADGE, LABEL = (255, 255, 255), (70, 130, 180), (0, 0, 0), (32, 32, 32), (0, 0, 0), (255, 255, 255)
COVER, STROKE = 0.15, 3
SOLID = {c: np.array(c, np.uint8) for c in (EDGE, INK, LABEL)}
#: The number of PNG's filter that stores differences from the row above; rows without any, deflated, by their number's power of two and their size.
UP = 2
SAME: dict[tuple[int, int], bytes] = {}
# Rows of 3 by 5 dots of the badges' characters, the left one first.
DOTS = {"B": (6, 5, 6, 5, 6), "0": (7, 5, 5, 5, 7), "1": (2, 6, 2, 2, 7), "2": (7, 1, 7, 4, 7), "3": (7, 1, 7, 1, 7), "4": (5, 5, 7, 1, 1), "5": (7, 4, 7, 1, 7), "6": (7, 4, 7, 5, 7), "7": (7, 1, 1, 1, 1), "8": (7, 5, 7, 5, 7), "9": (7, 5, 7, 1, 7)}


def encode_png(pixels: np.ndarray) -> bytes:
    """A PNG of rows of red, green and blue bytes."""
    return encode_bands(pixels, np.ones(len(pixels), np.int64))


def same_rows(n: int, size: int) -> list[bytes]:
    """Deflated blocks, whole bytes, of n rows of `size` bytes that are as the row above: the filter's number, then zeros. Powers of two are kept."""
    out = []
    for k in range(n.bit_length()):
        if n >> k & 1:
            if (k, size) not in SAME:
                packer = zlib.compressobj(9, zlib.DEFLATED, -15)
                SAME[k, size] = packer.compress((bytes([UP]) + bytes(size)) * (1 << k)) + packer.flush(zlib.Z_FULL_FLUSH)
            out.append(SAME[k, size])
    return out


def encode_bands(rows: np.ndarray, times: np.ndarray) -> bytes:
    """A PNG of rows of red, green and blue bytes, each as often as `times` says, one below the other.

    Each row is stored as its difference from the one above (filter 2). Of rows that repeat, what repeats is not packed again: its deflated form and its
    part of the checksum are known.
    """
    width, size = rows.shape[1], 3 * rows.shape[1]
    flat = rows.reshape(len(rows), size)
    stored = np.empty((len(rows), 1 + size), np.uint8)
    stored[:, 0] = UP
    stored[:1, 1:] = flat[:1]
    np.subtract(flat[1:], flat[:-1], out=stored[1:, 1:])
    packer, body, check = zlib.compressobj(3, zlib.DEFLATED, -15), [b"\x78\x9c"], 1
    for row, n in zip(stored, (times - 1).tolist(), strict=True):
        body.append(packer.compress(row))
        check = zlib.adler32(row, check)
        if n:
            body += [packer.flush(zlib.Z_FULL_FLUSH), *same_rows(n, size)]
            low, high = check & 0xFFFF, check >> 16  # of n rows, each of which adds UP to the low sum before its zeros
            check = (low + UP * n) % 65521 | (high + (1 + size) * (n * low + UP * n * (n + 1) // 2)) % 65521 << 16
    body += [packer.flush(), struct.pack(">I", check)]

    def chunk(kind: bytes, own: bytes) -> bytes:
        return struct.pack(">I", len(own)) + kind + own + struct.pack(">I", zlib.crc32(kind + own))

    header = struct.pack(">IIBBBBB", width, int(times.sum()), 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", b"".join(body)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """The pixels of what encode_png() wrote; ValueError where a chunk's checksum is wrong."""
    at, body, size = 8, b"", (0, 0)
    while at < len(data):
        n = struct.unpack(">I", data[at : at + 4])[0]
        kind, own = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if zlib.crc32(kind + own) != struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0]:
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            size = struct.unpack(">II", own[:8])
        body += own if kind == b"IDAT" else b""
        at += 12 + n
    width, height = size
    stored = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + 3 * width)
    return np.cumsum(stored[:, 1:], axis=0, dtype=np.uint8).reshape(height, width, 3)  # all rows are differences


def fill(pixels: np.ndarray, x1: int, y1: int, x2: int, y2: int, colour: tuple[int, int, int], cover: float = 1.0) -> None:
    """A box, edges included, as far as it lies on the page: colour over what is there, rounded half to even."""
    own = pixels[max(0, y1) : max(0, y2 + 1), max(0, x1) : max(0, x2 + 1)]
    own[:] = np.rint((1 - cover) * own.astype(float) + cover * np.array(colour, float)).astype(np.uint8)


def edges(x1: int, y1: int, x2: int, y2: int, width: int = STROKE) -> list[tuple[int, int, int, int]]:
    """The edges of a box, inwards, as boxes."""
    return [(x1, y1, x2, min(y2, y1 + width - 1)), (x1, max(y1, y2 - width + 1), x2, y2), (x1, y1, min(x2, x1 + width - 1), y2), (max(x1, x2 - width + 1), y1, x2, y2)]


def outline(pixels: np.ndarray, x1: int, y1: int, x2: int, y2: int, colour: tuple[int, int, int], width: int = STROKE) -> None:
    """The edges of a box, drawn inwards."""
    for box in edges(x1, y1, x2, y2, width):
        fill(pixels, *box, colour)


def word_bars(text: str, x: int, y: int, size: int) -> Iterator[tuple[int, int, int, int]]:
    """A line of text as a bar for each word, as wide as its characters are measured: no font is read, so no letters are drawn."""
    advance, at = CHAR * size, 0
    for word in text.split(" "):
        if word:
            yield x + round(at * advance), y + size // 4, x + round((at + len(word)) * advance) - 1, y + size - 1 - size // 4
        at += len(word) + 1


def label_dots(text: str, x: int, y: int, dot: int = 2) -> Iterator[tuple[int, int, int, int]]:
    """A badge's label in dots."""
    for k, c in enumerate(text):
        for row, bits in enumerate(DOTS.get(c, ())):
            for column in range(3):
                if bits >> (2 - column) & 1:
                    left, top = x + dot * (4 * k + column), y + dot * row
                    yield left, top, left + dot - 1, top + dot - 1


def strokes(blocks: list[dict]) -> Iterator[tuple[tuple[int, int, int, int], tuple[int, int, int], float]]:
    """(box, colour, cover) of all that is drawn of a page's blocks, in order: fills, outlines and texts in order of place, then badges."""
    blocks = sorted(blocks, key=lambda r: (r["place"], r["id"]))
    for r in blocks:
        box = tuple(int(r[c]) for c in ("x1", "y1", "x2", "y2"))
        yield box, FILL, COVER
        yield from ((e, EDGE, 1.0) for e in edges(*box))
        for i, line in enumerate(r["shown"] or ()):
            yield from ((bar, INK, 1.0) for bar in word_bars(line, box[0] + PAD, round(box[1] + PAD + i * (r["size"] * LINE + GAP)), int(r["size"])))
    for r in blocks:
        x1, y1, x2, y2 = (int(v) for v in r["badge"])
        yield (x1, y1, x2, y2), BADGE, 1.0
        yield from ((dot, LABEL, 1.0) for dot in label_dots(f"B{r['id']}", x1 + 4, y1 + 4))


def bands(blocks: list[dict], width: int, height: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of pixels of a page, from the top, and how many rows each of them is.

    Only boxes are drawn, so between neighbouring edges of boxes nothing changes: colours are worked out once for each cell between such edges.
    """
    drawn = list(strokes(blocks))
    ends = np.array([box for box, _, _ in drawn], np.int64).reshape(-1, 4)
    ends[:, 2:] += 1
    ends = np.clip(ends, 0, np.array([width, height, width, height]))
    xs, ys = (np.unique(np.concatenate([[0, most], ends[:, k], ends[:, k + 2]])) for k, most in ((0, width), (1, height)))
    at = np.stack([np.searchsorted(xs if k % 2 == 0 else ys, ends[:, k]) for k in range(4)], 1).tolist()
    cells = np.empty((len(ys) - 1, len(xs) - 1, 3), np.uint8)
    cells[:] = PAPER
    for (x1, y1, x2, y2), (_, colour, cover) in zip(at, drawn, strict=True):
        if cover == 1:
            cells[y1:y2, x1:x2] = SOLID[colour]
        else:
            fill(cells, x1, y1, x2 - 1, y2 - 1, colour, cover)
    return np.repeat(cells, np.diff(xs), axis=1), np.diff(ys)


def pictures(blocks: DataFrame, font: str | None = None) -> DataFrame:
    """(image, png) of blocks(image, place, id, text, x1, y1, x2, y2, width, height), one task's work a page at a time.

    The layout is that of layout.canvas(), worked out in columns; pixels are drawn in the tasks. Pages whose blocks all lack an area give no
    picture, as there.
    """
    image = blocks.schema["image"].dataType.simpleString()
    rows = laid_out(blocks, font).select("image", "place", "id", "x1", "y1", "x2", "y2", "width", "height", "size", "shown", "badge")

    def drawn(page: pa.Table) -> pa.Table:
        own = page.to_pylist()
        png = encode_bands(*bands(own, *(int(max(r[c] for r in own)) for c in ("width", "height"))))
        return pa.table({"image": page["image"].slice(0, 1), "png": pa.array([png], pa.binary())})

    # rows are few bytes and much work: dealt by a key that nothing else is dealt by, their partitions are not merged
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("part", F.xxhash64("image")).repartition(parts, "part").groupBy("part", "image").applyInArrow(drawn, f"image {image}, png binary")
