"""Methods against plain loops: chains against all tag paths, the network against a loop, JPEG against a bit-by-bit reader."""

import hashlib
import itertools
import struct

import numpy as np
import pytest

from handbill.llm import media, quality, toxicity

R = np.random.default_rng(3)


def every_path(emission, step):
    """P(tag 1) of each token and expected pairs of tags, over all paths."""
    n, total, p, pairs = len(emission), 0.0, np.zeros(len(emission)), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(emission[i] for i in range(n) if path[i]) + sum(step[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        p += w * np.array(path)
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += w
    return p / total, pairs / total


def test_forward_backward_against_enumeration():
    step = R.standard_normal((2, 2))
    length = np.array([1, 2, 5, 8])
    emission, weigh = R.standard_normal((4, 8)) * 3, np.array([1.0, 2.0, 0.5, 3.0])
    p, pairs = toxicity.forward_backward(emission, step, length, weigh)
    expected = np.zeros((2, 2))
    for i, n in enumerate(length):
        own, of_pairs = every_path(emission[i, :n], step)
        assert p[i, :n] == pytest.approx(own) and (p[i, n:] == 0).all()
        expected += weigh[i] * of_pairs
    assert pairs == pytest.approx(expected)


def test_long_chains_are_not_cut():
    step = np.array([[2.0, -1.0], [-1.0, 3.0]])
    length = np.array([65, 700, 128, 3, 64])
    emission = R.standard_normal(int(length.sum())) * 2
    found, at = toxicity.long_chains(emission, step, length), 0
    for n in length:
        p, _ = toxicity.forward_backward(emission[None, at : at + n], step, np.array([n]), np.ones(1))
        assert found[at : at + n] == pytest.approx(p[0], abs=1e-9)
        at += n


@pytest.mark.parametrize("text", ["İstanbul is İzmir nice vile town", "Straße 12x VILE. vileİ İİİ 9vile_vile", "é́ áb vile ٣٤ vile²  vile", "vile " * 200 + "İ vile"])
def test_offsets_are_the_tokens(text):
    tagger = toxicity.Tagger({b"w:vile": 12.0}, -6.0, np.zeros((2, 2)))
    tokens = [w for s in toxicity.sequences_of(text) for w in s]
    assert tokens == [m.group().encode() for m in toxicity.TOKEN.finditer(text)]
    p, _ = tagger.marginals([toxicity.sequences_of(text)], toxicity.Emissions(tagger.weights, tagger.bias))
    spans = toxicity.offsets(text, p, 0.5)
    covered = [m for m in toxicity.TOKEN.finditer(text) if any(s["begin"] <= m.start() and m.end() <= s["end"] for s in spans)]
    assert covered == [] or {m.group().lower() for m in covered} == {"vile"}
    assert len(covered) == sum(m.group().lower() == "vile" for m in toxicity.TOKEN.finditer(text)) > 0


def test_network_against_a_loop():
    net = quality.Network.fresh(4)
    for q in net.params():
        q += R.standard_normal(q.shape).astype(np.float32) * 0.1
    texts = [b"", b"short", bytes(R.integers(0, 256, 1000, dtype=np.uint8)), bytes(R.integers(97, 123, 448, dtype=np.uint8))]

    def plain(text):
        pooled, a = [], 0
        while True:
            part = text[a : a + quality.CHUNK].ljust(quality.CHUNK, b"\0")
            best = [-np.inf] * quality.FILTERS
            for place in range(0, quality.CHUNK - quality.KERNEL + 1, quality.STRIDE):
                x = np.concatenate([net.embed[b] for b in part[place : place + quality.KERNEL]])
                best = np.maximum(best, x @ net.filters)
            pooled.append(np.maximum(best + net.bias, 0))
            if a + quality.CHUNK >= len(text):
                break
            a += quality.STEP
        s = np.concatenate([np.mean(pooled, 0), np.max(pooled, 0), np.min(pooled, 0)])
        z = float((np.maximum(s @ net.hidden + net.hidden_bias, 0) @ net.out + net.out_bias).item())
        return 1 / (1 + np.exp(-z))

    assert net.score(texts) == pytest.approx([plain(t) for t in texts], abs=1e-4)


DC = {s: (c, n) for c, n, s in media.codes(media.DC_BITS, media.DC_SYMBOLS)}
AC_BITS, AC_SYMBOLS = (0, 3, *([0] * 14)), (0x00, 0x12, 0xF0)
AC = {s: (c, n) for c, n, s in media.codes(AC_BITS, AC_SYMBOLS)}


def packed(bits: str) -> bytes:
    bits += "1" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def block(difference: int, more: list[int]) -> str:
    """A block's bits: its DC difference, then AC symbols with ones as their values."""
    size = abs(difference).bit_length()
    code, n = DC[size]
    out = f"{code:0{n}b}" + (f"{difference if difference > 0 else difference + (1 << size) - 1:0{size}b}" if size else "")
    for symbol in more:
        code, n = AC[symbol]
        out += f"{code:0{n}b}" + "1" * (symbol & 15)
    return out


def colour(scans: list[list[tuple[int, str]]], sampling: int) -> bytes:
    """A file of 32 x 16 pixels and three components, the first sampled so; scans hold (component, bits)."""
    out = bytes([0xFF, media.SOI]) + media.segment(media.DQT, bytes([0]) + bytes([8]) * 64)
    out += media.segment(media.SOF0, struct.pack(">BHHB", 8, 16, 32, 3) + bytes([1, sampling, 0, 2, 0x11, 0, 3, 0x11, 0]))
    out += media.segment(media.DHT, bytes([0x00, *media.DC_BITS, *media.DC_SYMBOLS])) + media.segment(media.DHT, bytes([0x10, *AC_BITS, *AC_SYMBOLS]))
    for scan in scans:
        own = sorted({c for c, _ in scan})
        out += media.segment(media.SOS, bytes([len(own), *(x for c in own for x in (c + 1, 0x00)), 0, 63, 0])) + packed("".join(b for _, b in scan))
    return out + bytes([0xFF, media.EOI])


def test_colour_ac_and_several_scans():
    luma = R.integers(-120, 120, (2, 4))
    more = [0x12, 0xF0, 0x12, 0x00]
    plain = lambda c: [(c, block(5, [0x00])), *[(c, block(0, more))] * 7]
    row = luma.ravel()
    ours = [(0, block(int(d), more)) for d in np.diff(row, prepend=0)]
    separate = colour([ours, plain(1), plain(2)], 0x11)
    mixed, last = [], 0
    for unit in range(2):
        for y, x in ((0, 0), (0, 1), (1, 0), (1, 1)):
            value = int(luma[y, 2 * unit + x])
            mixed.append((0, block(value - last, [0x12, 0x00])))
            last = value
        mixed += [(1, block(3, [0x00])), (2, block(-4, [0xF0, 0x00]))]
    together = colour([[(0, "".join(b for _, b in mixed)), (1, ""), (2, "")]], 0x22)
    for file in (separate, together):
        ((image, grid),) = media.thumbnails([file])[0]
        assert (image.width, image.height) == (32, 16) and (grid == luma + 128).all()


def test_files_that_are_none(spark):
    good = media.encode([b"x" * 192])[0]
    rows = [(1, good), (2, None), (3, b""), (4, b"no file"), (5, good[: len(good) // 2]), (6, good + good), (7, good.replace(bytes([0xFF, 0xC0]), bytes([0xFF, 0xC2])))]
    found = {r["id"]: r for r in media.described(spark.createDataFrame([(*r, "kept", "gone") for r in rows], "id int, media binary, shard string, error string")).collect()}
    assert [found[i]["error"] is None for i in range(1, 8)] == [True, True, False, False, False, True, False]
    assert found[1]["thumbnail"] == b"x" * 192 and found[6]["thumbnail"] == b"x" * 384 and found[1]["shard"] == "kept"
    assert [found[i]["thumbnail_hash"] is None for i in range(1, 8)] == [False, True, True, True, True, False, True]


def bit_by_bit(file: bytes) -> bytes:
    """The samples of an image that media.encode() made, read without tables or lanes."""
    at = file.index(bytes([0xFF, media.SOS]))
    scan, bits = file[at + 10 : -2], ""
    table, out = {(n, c): s for c, n, s in media.codes(media.DC_BITS, media.DC_SYMBOLS)}, []
    for part in __import__("re").split(rb"\xff[\xd0-\xd7]", scan):
        bits, i, last = "".join(f"{b:08b}" for b in part.replace(b"\xff\x00", b"\xff")), 0, 128
        for _ in range(media.ROW):
            n = next(n for n in range(1, 17) if (n, int(bits[i : i + n], 2)) in table)
            size = table[n, int(bits[i : i + n], 2)]
            extra = bits[i + n : i + n + size]
            value = int(extra, 2) if size else 0
            last += value if not size or extra[0] == "1" else value - (1 << size) + 1
            out.append(last)
            assert bits[i + n + size] == "0"  # the end of the block
            i += n + size + 1
    return bytes(out)


def test_stored_form_and_feature(spark):
    texts = ["", "abc", "Straße " * 90, "ÿ" * 500]
    found = {r["doc_id"]: r for r in media.media_columns(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        raw = text.encode()
        payload = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        stored = media.encode([payload])[0]
        assert bit_by_bit(stored) == payload and (found[i]["media_bytes"], found[i]["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        grid = np.frombuffer(payload, np.uint8).reshape(-1, 192).astype(float)
        high = len(grid)
        areas = [grid[y * high // 8 : max(y * high // 8 + 1, (y + 1) * high // 8), x * 24 : x * 24 + 24].mean() for y in range(8) for x in range(8)]
        shown = int("".join("1" if a > np.mean(areas) else "0" for a in areas), 2)
        assert found[i]["feature"] == f"1536x{8 * high}:{shown:016x}"


def test_wide_images():
    for n in (media.MOST_BLOCKS * 192, media.MOST_BLOCKS * 192 + 192, 3 * media.MOST_BLOCKS * 192 + 384):
        payload = R.integers(0, 256, n, dtype=np.uint8).tobytes()
        (shown,) = media.thumbnails(media.encode([payload]))
        assert len(shown) == 1 and media.samples(shown) == payload
