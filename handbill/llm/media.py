"""Media columns: baseline JPEG, written with constant blocks and read back as luminance thumbnails."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handbill.llm.common import arrow_map, others, prepare, utf8

#: Samples that a payload is filled up to multiples of; blocks in a row are such a multiple too. Blocks that a JPEG's 16-bit
#: width and height allow.
ROW, MOST_BLOCKS = 192, 65_535 // 8
#: Samples that are coded together.
GROUP = 1 << 20

# The code lengths of luminance DC differences in Annex K of the JPEG standard (counts of codes of 1 to 16
# bits, then the symbols), and a table of AC codes whose only symbol ends a block.
DC_BITS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_SYMBOLS = tuple(range(12))
AC_BITS = (1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0)
AC_SYMBOLS = (0,)
SOI, EOI, SOF0, DHT, DQT, DRI, SOS, RST0, COM = 0xD8, 0xD9, 0xC0, 0xC4, 0xDB, 0xDD, 0xDA, 0xD0, 0xFE
#: Opens the comment that says how many samples an image holds; those after them fill up its last row.
HELD = b"samples "


def codes(bits: tuple[int, ...], symbols: tuple[int, ...]) -> list[tuple[int, int, int]]:
    """(code, its length, symbol) of a Huffman table, as the standard numbers them."""
    out, code, at = [], 0, 0
    for length, n in enumerate(bits, 1):
        for symbol in symbols[at : at + n]:
            out.append((code, length, symbol))
            code += 1
        at += n
        code <<= 1
    return out


def lookup(bits: tuple[int, ...], symbols: tuple[int, ...]) -> np.ndarray:
    """length << 8 | symbol by the next 16 bits; 0 where no code begins so."""
    out = np.zeros(1 << 16, np.int32)
    for code, length, symbol in codes(bits, symbols):
        out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return out


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(samples: int, width: int) -> bytes:
    """Up to the scan: one component of one block a sample, `width` in a row, all quantisers 8, a restart after each row.

    With those, a block's DC coefficient is its sample less 128, so samples come back as they were.
    """
    return b"".join([
        bytes([0xFF, SOI]),
        segment(COM, HELD + b"%d" % samples),
        segment(DQT, bytes([0]) + bytes([8]) * 64),
        segment(SOF0, struct.pack(">BHHB", 8, -(-samples // width) * 8, width * 8, 1) + bytes([1, 0x11, 0])),
        segment(DHT, bytes([0x00, *DC_BITS, *DC_SYMBOLS])),
        segment(DHT, bytes([0x10, *AC_BITS, *AC_SYMBOLS])),
        segment(DRI, struct.pack(">H", width)),
        segment(SOS, bytes([1, 1, 0x00, 0, 63, 0])),
    ])


def difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """(bits, how many) of a whole block by its DC difference + 255: size code, difference, end of block."""
    size_code = {symbol: (code, length) for code, length, symbol in codes(DC_BITS, DC_SYMBOLS)}
    value, count = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, length = size_code[size]
        extra = d if d >= 0 else d + (1 << size) - 1
        value[d + 255], count[d + 255] = (code << size | extra) << 1, length + size + 1
    return value, count


VALUE, COUNT = difference_codes()


def scans(samples: np.ndarray, image_rows: list[int]) -> list[bytes]:
    """Entropy-coded scans of images of one width that stand one after the other in samples (rows x width)."""
    d = samples.astype(np.int16)
    d[:, 1:] -= samples[:, :-1]
    d[:, 0] -= 128
    d += 255
    count = COUNT[d]
    bits = count.sum(1)
    size = -(-bits // 8)
    base = np.cumsum(size) - size
    at = (np.cumsum(count, axis=1) - count + 8 * base[:, None]).ravel()
    value, count = VALUE[d].ravel(), count.ravel()
    pad = 8 * size - bits  # rows end in ones
    at = np.concatenate([at, 8 * base + bits])
    value = np.concatenate([value, (np.uint64(1) << pad.astype(np.uint64)) - np.uint64(1)])
    count = np.concatenate([count, pad])
    word = at >> 5
    value <<= (64 - (at & 31) - count).astype(np.uint64)
    n = int(size.sum()) // 4 + 2
    total = np.bincount(word, (value >> np.uint64(32)).astype(float), n + 1)[: n + 1]
    total[1:] += np.bincount(word, (value & np.uint64(0xFFFFFFFF)).astype(float), n)[:n]
    flat = total.astype(np.uint64).astype(">u4").view(np.uint8)[: int(size.sum())]
    # a zero byte after each 0xFF, a restart marker after each row but an image's last
    last = np.cumsum(image_rows) - 1
    number = np.arange(len(samples)) - np.repeat(last - image_rows + 1, image_rows)
    marks = np.ones(len(samples), bool)
    marks[last] = False
    grow = 1 + (flat == 255).astype(np.int64)
    end = base + size - 1
    grow[end] += 2 * marks
    start = np.cumsum(grow) - grow
    out = np.zeros(int(grow.sum()), np.uint8)
    out[start] = flat
    mark = (start[end] + grow[end] - 2)[marks]
    out[mark], out[mark + 1] = 0xFF, RST0 + number[marks] % 8
    cut = start[end[last]] + grow[end[last]]
    return [out[a:b].tobytes() for a, b in zip([0, *cut[:-1]], cut, strict=True)]


def width_of(samples: int) -> int:
    """Samples in a row: ROW, or as many times that as make the image low enough."""
    return ROW * min(MOST_BLOCKS // ROW, max(1, -(-samples // (ROW * MOST_BLOCKS))))


def encode(payloads: list[bytes]) -> list[bytes]:
    """A JPEG file of each payload. One of over 66 million samples, the most that the format holds, is several in a row."""
    most = MOST_BLOCKS // ROW * ROW * MOST_BLOCKS
    parts = [(i, p[a : a + most]) for i, p in enumerate(payloads) for a in range(0, len(p), most)]
    out: list[list[bytes]] = [[] for _ in payloads]
    coded: dict[int, bytes] = {}
    by_width: dict[int, list[int]] = {}
    for k, (_, p) in enumerate(parts):
        by_width.setdefault(width_of(len(p)), []).append(k)
    for width, own in by_width.items():
        full = [parts[k][1] + b" " * (-len(parts[k][1]) % width) for k in own]
        coded |= zip(own, scans(np.frombuffer(b"".join(full), np.uint8).reshape(-1, width), [len(x) // width for x in full]), strict=True)
    for k, (i, p) in enumerate(parts):
        out[i].append(header(len(p), width_of(len(p))) + coded[k] + bytes([0xFF, EOI]))
    return [b"".join(x) for x in out]


@dataclass
class Image:
    """What the markers of one baseline image say, and its scan of the first component: the luminance."""

    width: int = 0
    height: int = 0
    held: int | None = None  # samples, of images that encode() made
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, across, down, quantiser
    quantisers: dict[int, int] = field(default_factory=dict)  # of the DC coefficient
    tables: dict[int, tuple] = field(default_factory=dict)
    interval: int = 0
    scan: tuple = ()  # (component, its DC table, its AC table) of each component of the scan
    data: tuple[int, int] = (0, 0)


def parse(file: bytes, at: int = 0) -> tuple[Image, int]:
    """The image that begins at `at`, and where it ends. Anything but a whole baseline image is a ValueError."""
    try:
        return markers(file, at)
    except (IndexError, KeyError, struct.error) as broken:
        raise ValueError("a marker is cut off or refers to nothing") from broken


def markers(file: bytes, at: int) -> tuple[Image, int]:
    image = Image()
    if file[at : at + 2] != bytes([0xFF, SOI]):
        raise ValueError("no JPEG begins here")
    at += 2
    while True:
        while file[at + 1] == 0xFF:
            at += 1
        marker = file[at + 1]
        if marker == EOI:
            raise ValueError("no scan of the first component")
        (size,) = struct.unpack_from(">H", file, at + 2)
        body = file[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == SOF0 or marker == 0xC1:
            depth, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            image.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            if depth != 8 or not image.height or not image.width or not n or any(not 1 <= x <= 4 for c in image.components for x in c[1:3]):
                raise ValueError("not an image of 8-bit samples and known size")
        elif 0xC2 <= marker <= 0xCF and marker not in (DHT, 0xC8, 0xCC):
            raise ValueError("not a baseline JPEG")
        elif marker == COM and body.startswith(HELD):
            image.held = int(body[len(HELD) :])
        elif marker == DQT:
            while body:
                wide = body[0] >> 4
                image.quantisers[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + 64 * (1 + wide) :]
        elif marker == DHT:
            while body:
                bits = tuple(body[1:17])
                image.tables = image.tables | {body[0]: (bits, tuple(body[17 : 17 + sum(bits)]))}
                body = body[17 + sum(bits) :]
        elif marker == DRI:
            (image.interval,) = struct.unpack(">H", body)
        elif marker == SOS:
            number = {c[0]: i for i, c in enumerate(image.components)}
            scan = tuple((number[body[1 + 2 * i]], body[2 + 2 * i] >> 4, 16 + (body[2 + 2 * i] & 15)) for i in range(body[0]))
            end = at
            while True:  # the first marker that is neither a stuffed byte nor a restart
                end = file.index(0xFF, end)
                if file[end + 1] and not RST0 <= file[end + 1] < RST0 + 8:
                    break
                end += 2
            if scan[0][0] == 0:  # components come in their order, in each scan too
                image.quantisers = {k: image.quantisers[k] for k in (image.components[0][3],)}
                tables = {k: image.tables[k] for _, *own in scan for k in own}
                return replace(image, scan=scan, data=(at, end), tables=tables), end_of(file, end)
            at = end


def end_of(file: bytes, at: int) -> int:
    """Where the image ends whose scan ends at `at`: later scans and tables are read over."""
    while file[at + 1] != EOI:
        if file[at + 1] == 0xFF:
            at += 1
            continue
        (size,) = struct.unpack_from(">H", file, at + 2)
        scan = file[at + 1] == SOS
        at += 2 + size
        while scan and (file[at] != 0xFF or not file[at + 1] or RST0 <= file[at + 1] < RST0 + 8):
            at = file.index(0xFF, at + 1 + (file[at] == 0xFF))
    return at + 2


def lanes(scan: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a scan without stuffing and restart markers, and where each interval begins."""
    full = np.flatnonzero(scan[:-1] == 0xFF) if len(scan) else np.zeros(0, np.int64)
    after = scan[full + 1]
    keep = np.ones(len(scan), bool)
    keep[full[after == 0] + 1] = False
    mark = full[(after >= RST0) & (after < RST0 + 8)]
    keep[mark] = keep[mark + 1] = False
    return scan[keep], np.concatenate([[0], np.cumsum(keep)[mark]])


def luminance(data: np.ndarray, begin: np.ndarray, units: np.ndarray, order: list[tuple[int, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Huffman-decodes intervals side by side: for each block of a unit, DC values (intervals x units).

    order: component, DC table and AC table of each block of a unit. AC coefficients are read over.
    """
    data = np.concatenate([data, np.full(8, 0xFF, np.uint8)]).astype(np.uint32)
    window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    limit = len(window) - 1

    def peek(at: np.ndarray) -> np.ndarray:
        return (window[np.minimum(at >> 3, limit)] << (at & 7).astype(np.uint32)) >> 16

    most = int(units.max(initial=0))
    out = [np.zeros((len(begin), most), np.int32) for _ in order]
    at = 8 * begin.astype(np.int64)
    last = {c: np.zeros(len(begin), np.int64) for c, _, _ in order}
    even = bool((units == most).all())
    for unit in range(most):
        live = slice(None) if even else np.flatnonzero(units > unit)
        p = at[live]
        for k, (c, dc, ac) in enumerate(order):
            code = dc[peek(p)]
            size = code & 0xFF
            p = p + (code >> 8)
            extra = (peek(p) >> (16 - size).astype(np.uint32)).astype(np.int64)
            p = p + size
            low = extra < (1 << size >> 1)
            value = last[c][live] + extra - low * ((1 << size) - 1)
            last[c][live] = value
            out[k][live, unit] = value
            place, todo = np.ones(len(p), np.int64), np.arange(len(p))
            while len(todo):
                code = ac[peek(p[todo])]
                symbol, length = code & 0xFF, code >> 8
                if not (length > 0).all():
                    raise ValueError("no such code")
                p[todo] += length + (symbol & 15)
                ends = symbol == 0
                if ends.all():
                    break
                place[todo] += np.where(ends, 64, (symbol >> 4) + 1)
                todo = todo[place[todo] < 64]
        at[live] = p
    return out


def thumbnails(files: list[bytes]) -> list[list[tuple[Image, np.ndarray]]]:
    """For each file its images, each with its luminance, one sample a block; images of one kind are decoded together."""
    images, at_file = [], []
    for i, file in enumerate(files):
        at = 0
        while at < len(file):
            image, at = parse(file, at)
            images.append(image)
            at_file.append(i)
    kinds: dict[tuple, list[int]] = {}
    for i, m in enumerate(images):
        kinds.setdefault((tuple(m.components), m.scan, tuple(sorted(m.tables.items()))), []).append(i)
    shown: list[np.ndarray] = [np.zeros((0, 0), np.uint8)] * len(images)
    for own in kinds.values():
        first = images[own[0]]
        across, down = (max(c[k] for c in first.components) for k in (1, 2))
        _, h, v, quantiser = first.components[0]
        alone = len(first.scan) == 1  # then a unit is one block of this component, else one of all of them
        tables = {k: lookup(*t) for k, t in first.tables.items()}
        order, spot = [], []
        for c, dc, ac in first.scan:
            for y in range(1 if alone else first.components[c][2]):
                for x in range(1 if alone else first.components[c][1]):
                    order.append((c, tables[dc], tables[ac]))
                    spot.append((c, y, x))
        data, begin, units, held, shape = [], [], [], 0, []
        for i in own:
            m = images[i]
            bytes_, starts = lanes(np.frombuffer(files[at_file[i]], np.uint8)[m.data[0] : m.data[1]])
            blocks_wide, blocks_high = -(-(-(-m.width * h // across)) // 8), -(-(-(-m.height * v // down)) // 8)
            wide, high = (blocks_wide, blocks_high) if alone else (-(-m.width // (8 * across)), -(-m.height // (8 * down)))
            n = wide * high
            each = m.interval or n
            if len(starts) < -(-n // each):
                raise ValueError("a restart is missing")
            data.append(bytes_)
            begin.append(starts[: -(-n // each)] + held)
            units.append(np.minimum(each, n - each * np.arange(-(-n // each))))
            held += len(bytes_)
            shape.append((wide, high, blocks_wide, blocks_high, len(units[-1])))
        decoded = luminance(np.concatenate(data), np.concatenate(begin), np.concatenate(units), order)
        counts, lane = np.concatenate(units), 0
        for i, (wide, high, blocks_wide, blocks_high, n) in zip(own, shape, strict=True):
            grid = np.zeros((high, wide) if alone else (high * v, wide * h), np.int64)
            mask = np.arange(decoded[0].shape[1])[None, :] < counts[lane : lane + n, None]
            for k, (c, y, x) in enumerate(spot):
                if c == 0:
                    (grid if alone else grid[y::v, x::h])[:] = decoded[k][lane : lane + n][mask].reshape(high, wide)
            lane += n
            grid = np.clip(np.rint(grid * images[i].quantisers[quantiser] / 8).astype(np.int64) + 128, 0, 255).astype(np.uint8)
            shown[i] = grid[:blocks_high, :blocks_wide]
    out: list[list[tuple[Image, np.ndarray]]] = [[] for _ in files]
    for i, image, grid in zip(at_file, images, shown, strict=True):
        out[i].append((image, grid))
    return out


def samples(shown: list[tuple[Image, np.ndarray]]) -> bytes:
    """The samples of a file's images, without those that fill up a last row."""
    return b"".join(x.tobytes() if m.held is None else x.tobytes()[: m.held] for m, x in shown)


def read_or_error(files: list[bytes]) -> list[tuple]:
    """(width, height, thumbnail, thumbnail_hash, error) of each file; one that can't be read has the error alone."""
    try:
        found = thumbnails(files)
    except ValueError as broken:
        if len(files) == 1:
            return [(None, None, None, None, str(broken))]
        return [x for file in files for x in read_or_error([file])]
    out = []
    for shown in found:
        if not shown:
            out.append((None, None, None, None, "no JPEG begins here"))
            continue
        image, grid = shown[0]
        out.append((image.width, image.height, samples(shown), f"{average_hash(grid):016x}", None))
    return out


def average_hash(thumbnail: np.ndarray) -> int:
    """64 bits: which of 8 x 8 areas are lighter than their mean."""
    high, wide = thumbnail.shape
    total = np.zeros((high + 1, wide + 1), np.int64)
    total[1:, 1:] = thumbnail.astype(np.int64).cumsum(0).cumsum(1)
    y0, x0 = np.arange(8) * high // 8, np.arange(8) * wide // 8
    y1, x1 = np.maximum(y0 + 1, np.arange(1, 9) * high // 8), np.maximum(x0 + 1, np.arange(1, 9) * wide // 8)
    area = total[y1][:, x1] - total[y0][:, x1] - total[y1][:, x0] + total[y0][:, x0]
    mean = area / ((y1 - y0)[:, None] * (x1 - x0)[None, :])
    return int.from_bytes(np.packbits(mean > mean.mean()).tobytes(), "big")


def stored(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every whole text as JPEG, one block a byte, filled up with spaces to a multiple of ROW.

    Null texts count as empty; an empty payload is one row of spaces. Rows that repeat give rows that repeat.
    """
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def write(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = utf8(batch.column(1))
            payloads = [x + b" " * ((-len(x)) % ROW if x else ROW) for x in texts]
            media = [x for group in groups(payloads) for x in encode(group)]
            return pa.record_batch([batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

        return write

    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, n_bytes bigint, media binary", make)


def groups(parts: list[bytes]) -> list[list[bytes]]:
    out: list[list[bytes]] = []
    held = GROUP
    for x in parts:
        if not out or held + len(x) > GROUP:
            out.append([])
            held = 0
        out[-1].append(x)
        held += len(x)
    return out


def described(media: DataFrame) -> DataFrame:
    """media's rows with width, height, thumbnail (its samples), thumbnail_hash and error, from the stored bytes alone.

    Any baseline JPEG will do, in one scan or several, of one component or more; another file has null in all but error.
    Of several images in a row, width, height and hash are the first's; thumbnail holds the samples of all. Null media has null
    in all five. Other columns pass through, but for those named like a new one.
    """
    kept = [c for c in others(media, "width", "height", "thumbnail", "thumbnail_hash", "error")]

    def make():
        def read(batch: pa.RecordBatch) -> pa.RecordBatch:
            files = batch.column(batch.schema.get_field_index("media")).to_pylist()
            shown = iter([x for group in groups([x for x in files if x is not None]) for x in read_or_error(group)])
            width, height, samples_, hashed, error = zip(*[(None,) * 5 if x is None else next(shown) for x in files], strict=True)
            columns = [pa.array(width, pa.int32()), pa.array(height, pa.int32()), pa.array(samples_, pa.binary()), pa.array(hashed, pa.string()), pa.array(error, pa.string())]
            return pa.record_batch([*batch.columns, *columns], [*batch.schema.names, "width", "height", "thumbnail", "thumbnail_hash", "error"])

        return read

    new = [("width", T.IntegerType()), ("height", T.IntegerType()), ("thumbnail", T.BinaryType()), ("thumbnail_hash", T.StringType()), ("error", T.StringType())]
    rows = media.select(*kept)
    return arrow_map(rows, T.StructType([*rows.schema.fields, *(T.StructField(n, t) for n, t in new)]), make)


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of every text."""
    payload = F.col("thumbnail")
    return described(stored(docs)).select(
        "doc_id",
        "n_bytes",
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.concat_ws("x", "width", "height"), "thumbnail_hash").alias("feature"),
    )
