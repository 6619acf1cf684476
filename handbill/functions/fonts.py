"""Widths of text from a font file, and text wrapped and fitted by them."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F


class Advances:
    """How wide each character of a TrueType or OpenType font is, as a share of the font size."""

    def __init__(self, data: bytes):
        """Reads the tables head, hhea, hmtx and cmap (formats 4 and 12) of a font file."""
        count = struct.unpack_from(">H", data, 4)[0]
        at = {data[12 + 16 * k : 16 + 16 * k].decode("latin-1"): struct.unpack_from(">I", data, 20 + 16 * k)[0] for k in range(count)}
        units = struct.unpack_from(">H", data, at["head"] + 18)[0]
        metrics = struct.unpack_from(">H", data, at["hhea"] + 34)[0]
        wide = [struct.unpack_from(">H", data, at["hmtx"] + 4 * k)[0] / units for k in range(metrics)]
        self.missing = wide[0]
        self.share = {c: wide[min(g, metrics - 1)] for c, g in glyphs(data, at["cmap"]).items()}

    def width(self, text: str, size: int) -> float:
        return size * sum(self.share.get(ord(c), self.missing) for c in text)


def glyphs(data: bytes, cmap: int) -> dict[int, int]:
    """Glyph numbers by character, of the fullest Unicode table there is."""
    tables = [struct.unpack_from(">HHI", data, cmap + 4 + 8 * k) for k in range(struct.unpack_from(">H", data, cmap + 2)[0])]
    found: dict[int, int] = {}
    for platform, kind, offset in tables:
        at = cmap + offset
        form = struct.unpack_from(">H", data, at)[0]
        if (platform, kind) not in ((0, 3), (0, 4), (0, 6), (3, 1), (3, 10)) or form not in (4, 12):
            continue
        own: dict[int, int] = {}
        if form == 12:
            for k in range(struct.unpack_from(">I", data, at + 12)[0]):
                first, last, glyph = struct.unpack_from(">III", data, at + 16 + 12 * k)
                own |= {c: glyph + c - first for c in range(first, last + 1)}
        else:
            n = struct.unpack_from(">H", data, at + 6)[0] // 2
            ends, starts, deltas, offsets = (at + 14 + x for x in (0, 2 * n + 2, 4 * n + 2, 6 * n + 2))
            for k in range(n):
                last, first, delta, jump = (struct.unpack_from(">H", data, x + 2 * k)[0] for x in (ends, starts, deltas, offsets))
                for c in range(first, min(last, 0xFFFE) + 1):
                    glyph = c if not jump else struct.unpack_from(">H", data, offsets + 2 * k + jump + 2 * (c - first))[0]
                    if glyph or not jump:
                        own[c] = (glyph + delta) & 0xFFFF
        found = own if len(own) > len(found) else found
    return found


def wrapped(text: str, size: int, width: float, font: Advances) -> list[str]:
    """Lines of a text, broken greedily between words; line breaks stay, a word too long stands alone."""
    out = []
    for paragraph in text.split("\n"):
        now = None
        for word in paragraph.split():
            longer = word if now is None else f"{now} {word}"
            if now is not None and font.width(longer, size) > width:
                out.append(now)
                longer = word
            now = longer
        out.append(now or "")
    return out


def fitted(text: str, width: float, height: float, font: Advances, sizes: tuple[int, int], line: float, gap: float) -> tuple[int, list[str]]:
    """The largest size whose lines fit, else the smallest, and the lines.

    A larger size never needs fewer lines, and each is higher: what fits is found by halving, not by trying every size.
    """
    low, high = sizes
    best = low, wrapped(text, low, width, font)
    while low <= high:
        size = (low + high + 1) // 2
        lines = wrapped(text, size, width, font)
        if len(lines) * (size * line + gap) - gap <= height:
            best, low = (size, lines), size + 1
        else:
            high = size - 1
    return best


def fit_font(path: str, sizes: tuple[int, int], line: float, gap: float):
    """An Arrow function (text, width, height) -> struct(size, lines) by the widths of the font file at path, which is read once, here."""
    with open(path, "rb") as f:
        font = Advances(f.read())

    @F.pandas_udf("size int, lines array<string>")
    def fit(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [fitted(t or "", w, h, font, sizes, line, gap) for t, w, h in zip(*batch, strict=True)]
            yield pd.DataFrame({"size": [r[0] for r in rows], "lines": [r[1] for r in rows]})

    return fit
