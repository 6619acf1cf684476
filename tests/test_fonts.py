"""Widths from a font file made here, and texts fitted by them against all sizes tried in turn."""

import random
import struct

from handbill.functions import fonts
from handbill.operators import layout


def font_file(shares, form):
    """A font of 1,000 units with these advances by character, the first glyph being the missing one."""
    chars = sorted(shares)
    advances = [500, *(shares[c] for c in chars)]
    head, hhea = bytes(18) + struct.pack(">H", 1000) + bytes(34), bytes(34) + struct.pack(">H", len(advances))
    hmtx = b"".join(struct.pack(">Hh", a, 0) for a in advances)
    if form == 12:
        groups = b"".join(struct.pack(">III", ord(c), ord(c), k + 1) for k, c in enumerate(chars))
        table = struct.pack(">HHIII", 12, 0, 16 + len(groups), 0, len(chars)) + groups
    else:
        codes = [*map(ord, chars), 0xFFFF]
        deltas = [(k + 1 - c) & 0xFFFF for k, c in enumerate(codes[:-1])] + [1]
        body = b"".join(struct.pack(f">{len(codes)}H", *x) for x in (codes,)) + bytes(2) + struct.pack(f">{len(codes)}H", *codes) + struct.pack(f">{len(codes)}H", *deltas) + bytes(2 * len(codes))
        table = struct.pack(">HHHHHHH", 4, 14 + len(body), 0, 2 * len(codes), 0, 0, 0) + body
    cmap = struct.pack(">HHHHI", 0, 1, 3, 10 if form == 12 else 1, 12) + table
    tables = {"cmap": cmap, "head": head, "hhea": hhea, "hmtx": hmtx}
    at, out, bodies = 12 + 16 * len(tables), struct.pack(">IHHHH", 0x10000, len(tables), 0, 0, 0), b""
    for name, body in tables.items():
        out += name.encode() + struct.pack(">III", 0, at + len(bodies), len(body))
        bodies += body
    return out + bodies


SHARES = {" ": 250, "i": 200, "m": 900, "a": 550, "é": 560}


def test_widths():
    for form in (4, 12):
        font = fonts.Advances(font_file(SHARES, form))
        assert abs(font.width("mia é?", 10) - 10 * (0.9 + 0.2 + 0.55 + 0.25 + 0.56 + 0.5)) < 1e-9
    assert abs(fonts.Advances(font_file(SHARES | {"\U0001f600": 1200}, 12)).width("\U0001f600", 5) - 6) < 1e-9


def test_fitted_against_every_size():
    r = random.Random(3)
    font = fonts.Advances(font_file(SHARES, 4))
    for _ in range(300):
        text = "".join(r.choices("mia é\n", k=r.randint(0, 120)))
        width, height = r.randint(8, 300), r.randint(8, 150)
        tried = [(s, fonts.wrapped(text, s, width, font)) for s in range(16, 7, -1)]
        want = next(((s, x) for s, x in tried if len(x) * (s + 3) - 3 <= height), tried[-1])
        assert fonts.fitted(text, width, height, font, (8, 16), 1.0, 3) == want


def test_layout_by_a_font(spark, tmp_path):
    """Narrow letters share lines that a fixed width would break."""
    path = tmp_path / "font.ttf"
    path.write_bytes(font_file(SHARES, 12))
    rows = [(1, 1, 0, "iiii iiii iiii", 0.0, 40.0, 90.0, 90.0, 300, 200), (1, 2, 1, "mmmm mmmm", 0.0, 100.0, 90.0, 190.0, 300, 200)]
    blocks = spark.createDataFrame(rows, "image long, place int, id int, text string, x1 double, y1 double, x2 double, y2 double, width int, height int")
    found = {r["id"]: (r["size"], r["shown"]) for r in layout.laid_out(blocks, str(path)).collect()}
    assert found == {0: (16, ["iiii iiii iiii"]), 1: (16, ["mmmm", "mmmm"])}
    assert "iiii iiii iiii" in layout.canvas(blocks, str(path)).first()["svg"]
