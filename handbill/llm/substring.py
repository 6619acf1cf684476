"""Substring deduplication by compressed FM-indexes over wavelet matrices."""

from __future__ import annotations

from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handbill.llm.common import arrow_map, materialise, others, prepare, text_or_empty, utf8

#: Words of an anchor: of the runs of that many words in a window, the one with the least hash.
ANCHOR = 6
#: Bytes of text in a home, the group of documents that is read together again, and in a block of texts hashed at once.
HOME_BYTES, BLOCK_BYTES = 4 << 20, 1 << 18
#: Distinct segments that share an anchor and an index. More of them are dealt by further anchors: by the ORDERS least runs
#: of a window instead of the least one, and at last by the whole window.
CROWD, ORDERS, SALTS = 2_000, (2, 4, 8, None), 32
#: Odd multipliers for hashes over bytes and words, and constants of the SplitMix64 finaliser.
BASE_BYTE, BASE_WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

U64 = np.uint64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(19, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 2**64)):
            x = np.full(size, b, U64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _powers[base] = (both[0], both[1])
    return _powers[base]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(MIX[0])
    x = (x ^ (x >> U64(27))) * U64(MIX[1])
    return x ^ (x >> U64(31))


class Words:
    """The words of a block of texts: where they are, and hashes of runs of them, from prefix sums.

    Hashes say which windows are looked at together, never that words are equal: some texts have equal sums, whatever the base.
    `bits` are those that a hash keeps; with few of them more windows meet.
    """

    def __init__(self, texts: list[bytes], bits: int = 64):
        self.short = U64(64 - bits)
        self.text = b"\n".join(texts)
        b = np.frombuffer(self.text, np.uint8)
        solid = np.zeros(len(b) + 2, bool)
        solid[1:-1] = (b > 32) | ((b < 32) & ((b < 9) | (b > 13)))
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        self.begin, self.end, self.n = edge[::2], edge[1::2], len(edge) // 2
        up, down = powers(BASE_BYTE, len(b) + 1)
        total = np.zeros(len(b) + 1, U64)
        np.cumsum((b + U64(1)) * up[: len(b)], out=total[1:])
        size = (self.end - self.begin).astype(U64)
        self.hash = mixed((total[self.end] - total[self.begin]) * down[self.begin] + size)
        up, self.down = powers(BASE_WORD, self.n + 1)
        self.total = np.zeros(self.n + 1, U64)
        np.cumsum(self.hash * up[: self.n], out=self.total[1:])
        ends = np.cumsum([len(x) + 1 for x in texts])
        #: the text of each word, and the first word of each text
        self.of = np.searchsorted(ends, self.begin, "right")
        self.first = np.searchsorted(self.begin, ends - [len(x) + 1 for x in texts])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the runs of words [start, end)."""
        return mixed((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(U64)) >> self.short

    def digests(self, start: np.ndarray, end: np.ndarray) -> list[bytes]:
        """Digests of the words of runs [start, end): equal for equal words, and for no others."""
        spans = zip(self.begin[start].tolist(), self.end[end - 1].tolist(), strict=True)
        return [blake2b(b" ".join(self.text[a:b].split()), digest_size=16).digest() for a, b in spans]

    def windows(self, window: int) -> np.ndarray:
        """First words of the windows that lie in one text."""
        count = max(0, self.n - window + 1)
        return np.flatnonzero(self.of[:count] == self.of[self.n - count :]) if count else np.zeros(0, np.int64)

    def keys(self, at: np.ndarray, window: int, order: int | None) -> np.ndarray:
        """Of windows that begin at `at`: a hash of their `order` least runs of ANCHOR words; of all words for None.

        Equal windows have equal keys, whatever stands around them.
        """
        anchor = min(ANCHOR, window)
        span = window - anchor + 1
        if order is None or order >= span:
            return self.runs(at, at + window)
        first = np.arange(self.n - anchor + 1)
        h = np.lib.stride_tricks.sliding_window_view(self.runs(first, first + anchor), span)
        out = np.empty(len(at), U64)
        for a in range(0, len(at), 1 << 14):
            least = np.sort(np.partition(h[at[a : a + (1 << 14)]], order - 1, axis=1)[:, :order], axis=1)
            out[a : a + (1 << 14)] = 0
            for k in range(order):
                out[a : a + (1 << 14)] = mixed((out[a : a + (1 << 14)] + least[:, k]) * U64(BASE_WORD))
        return out

    def segments(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, number of windows, anchor's hash) of each run of windows with one anchor.

        A window's anchor is its leftmost run of ANCHOR words with the least hash. Equal windows have equal anchors at
        equal places, so windows need only be held against those of the same anchor.
        """
        count, anchor = self.n - window + 1, min(ANCHOR, window)
        if count < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
        best = np.arange(self.n - anchor + 1)
        h = self.runs(best, best + anchor)
        width, span = 1, window - anchor + 1
        while width < span:  # the leftmost least of `width` places, from two halves that overlap
            step = min(width, span - width)
            left, right = best[:-step], best[step:]
            best = np.where(h[right] < h[left], right, left)
            width += step
        whole = np.flatnonzero(self.of[:count] == self.of[window - 1 :])  # in one text
        best = best[whole]
        new = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]])[: len(best)])
        return whole[new], np.diff(np.append(new, len(best))), h[best[new]]


def blocks(texts: list[bytes], most: int = BLOCK_BYTES) -> list[tuple[int, int]]:
    """Ranges of texts of under `most` bytes together, or of a single text."""
    out, start, held = [], 0, 0
    for i, x in enumerate(texts):
        if held and held + len(x) > most:
            out.append((start, i))
            start, held = i, 0
        held += len(x)
    return [*out, (start, len(texts))] if texts else []


class WaveletMatrix:
    """Ranks of symbols in a sequence: a bit vector for each bit of the symbols, with counts for each word of 64."""

    def __init__(self, symbols: np.ndarray):
        self.n, self.bits = len(symbols), max(1, int(symbols.max(initial=0)).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.packbits(np.concatenate([bit.astype(np.uint8), np.zeros(-self.n % 64 + 64, np.uint8)]), bitorder="little").view("<u8")
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(self.n - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place, plus where the symbol's own block begins."""
        for k in range(self.bits):
            word = at >> 6
            below = self.words[k][word] & ((U64(1) << (at & 63).astype(U64)) - U64(1))
            ones = self.counts[k][word] + np.bitwise_count(below).astype(np.int32)
            at = np.where((symbol >> (self.bits - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at


class FMIndex:
    """Backward search over a sequence of symbols above 0, in which 0 ends each part."""

    def __init__(self, sequence: np.ndarray, depth: int):
        """depth: symbols by which suffixes have to be in order, at least the longest pattern."""
        n = len(sequence)
        rank, width = sequence.astype(np.int64), 1
        while width < depth:
            second = np.concatenate([rank[width:] + 1, np.zeros(min(width, n), np.int64)])[:n]
            key = rank * (int(second.max(initial=0)) + 1) + second
            order = np.argsort(key, kind="stable")
            new = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
            rank = np.empty(n, np.int64)
            rank[order] = new
            width *= 2
            if new[-1] == n - 1:
                break
        self.suffixes = np.argsort(rank, kind="stable")
        self.matrix = WaveletMatrix(sequence[self.suffixes - 1])
        symbols = int(sequence.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))])
        self.block = self.matrix.rank(np.arange(symbols), np.zeros(symbols, np.int64))

    def search(self, sequence: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lo, hi, matched) of the patterns sequence[start : start + length], searched backwards.

        The matching statistic of a pattern that has but one place left is not followed further: matched then is below length.
        """
        last = sequence[start + length - 1]
        lo, hi, matched = self.first[last], self.first[last + 1], np.ones(len(start), np.int64)
        alive = np.flatnonzero(hi - lo > 1)
        for back in range(2, length + 1):
            if not len(alive):
                break
            c = sequence[start[alive] + length - back]
            base = self.first[c] - self.block[c]
            lo[alive] = base + self.matrix.rank(c, lo[alive])
            hi[alive] = base + self.matrix.rank(c, hi[alive])
            matched[alive] = back
            alive = alive[hi[alive] - lo[alive] > 1]
        return lo, hi, matched


def least_in(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of values[lo:hi] for each pair, hi > lo, from a sparse table."""
    out = np.empty(len(lo), values.dtype)
    size = np.frexp((hi - lo).astype(float))[1] - 1
    row = values
    for k in range(int(size.max(initial=0)) + 1):
        own = np.flatnonzero(size == k)
        out[own] = np.minimum(row[lo[own]], row[hi[own] - (1 << k)])
        if len(row) > 1 << k:
            row = np.minimum(row[: -(1 << k)], row[1 << k :])
    return out


def repeated_windows(parts: pa.Table, window: int) -> pa.Table:
    """Of a shard's distinct segments, runs of windows that start earlier elsewhere: (doc_id, tie, start, end) in words.

    parts has for each segment its words and its earliest place (doc_id, tie, start). One FM-index holds all of them; each
    segment's windows are searched in it, and a window whose least place is not its own is a repeat.
    """
    parts = parts.take(pc.sort_indices(parts, [("doc_id", "ascending"), ("tie", "ascending"), ("start", "ascending")], null_placement="at_end"))
    words = [x.split(b" ") for x in parts["words"].to_pylist()]
    size = np.array([len(x) for x in words])
    code: dict[bytes, int] = {}
    flat = np.array([code.setdefault(w, len(code) + 1) for x in words for w in x], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    sequence = np.zeros(int(size.sum()) + len(size), np.int64)
    sequence[np.arange(len(flat)) + np.repeat(np.arange(len(size)), size)] = flat
    count = size - window + 1
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[owner] + inside
    index = FMIndex(sequence, window)
    lo, hi, matched = index.search(sequence, start, window)
    many = np.flatnonzero((matched == window) & (hi - lo > 1))
    # rows are in the order of their places, so the least place in the sequence is the earliest in the corpus
    again = many[least_in(index.suffixes, lo[many], hi[many]) < start[many]]
    at, ends = joined_runs(owner[again], inside[again], window)
    own = parts.take(pa.array(owner[again][at]))
    base = own["start"].to_numpy()
    return pa.table({"doc_id": own["doc_id"], "tie": own["tie"], "start": pa.array(base + inside[again][at]), "end": pa.array(base + ends)})


def joined_runs(owner: np.ndarray, inside: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of consecutive windows of one owner begin, and where their words end."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)]))
    return new, inside[np.append(new[1:], len(owner)) - 1] + window


def keep(text: bytes, spans: np.ndarray | None) -> tuple[int, int, str]:
    """Words, removed words, and the others joined by one space; spans are rows (start, end) of ranges of words."""
    words = text.split()
    n = len(words)
    if spans is not None:
        gone = np.zeros(n + 1, np.int64)
        np.add.at(gone, spans[:, 0], 1)
        np.add.at(gone, spans[:, 1], -1)
        words = [w for w, x in zip(words, np.cumsum(gone)[:-1].tolist(), strict=True) if not x]
    return n, n - len(words), b" ".join(words).decode()


def by_document(table: pa.Table) -> dict[tuple, np.ndarray]:
    """Row numbers of each (doc_id, tie)."""
    rows: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(table["doc_id"].to_pylist(), table["tie"].to_pylist(), strict=True)):
        rows.setdefault(key, []).append(i)
    return {k: np.array(v) for k, v in rows.items()}


def shared_segments(texts: list[bytes], wanted: np.ndarray, window: int, bits: int, named: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Segments of texts whose anchor is in the sorted `wanted`: (text, first word, windows, place in wanted, digest if named)."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
    digests: list[bytes] = []
    for a, b in blocks(texts) if len(wanted) else []:
        w = Words(texts[a:b], bits)
        first, count, h = w.segments(window)
        h = h.view(np.int64)
        place = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
        hit = np.flatnonzero(wanted[place] == h)
        first, count = first[hit], count[hit]
        for x, y in zip(out, (a + w.of[first], first - w.first[w.of[first]], count, place[hit]), strict=True):
            x.append(y)
        if named:
            digests += w.digests(first, first + count + window - 1)
    return (*(np.concatenate(x) for x in out), digests)


def once(own: pa.Table) -> pa.Table:
    """doc_id, _tie and text of the first of the rows that repeat in both."""
    own = own.select(["doc_id", "_tie", "text"])
    first = by_document(own.select(["doc_id", "_tie"]).rename_columns(["doc_id", "tie"])).values()
    return own.take(pa.array([x[0] for x in first], pa.int64()))


def remove_repeats(docs: DataFrame, window: int = 20, bits: int = 64) -> DataFrame:
    """docs with n_words, n_removed and kept: the words that no repeated window covers, joined by one space.

    A window of `window` words is a repeat if its words also start earlier: in a smaller doc_id or earlier in the same
    document. Windows meet by anchors, runs of words chosen by their content. Anchors that occur once are left out
    after a count. Of the others, segments (runs of windows of one anchor) that are equal are brought together by
    BLAKE2 digests of their words; where an anchor has several distinct ones, these go to shards by anchor, each with one FM-index, in
    which all their windows are searched. A passage in ever other surroundings gives an anchor ever more distinct segments.
    Where they are over CROWD, they are cut where their second anchors change, equal pieces are brought together by their
    words, and the rest is dealt to indexes by both anchors; where that still leaves a crowd, by more anchors. Equal
    windows meet at every step, and no index grows with the crowd. Anchors are hashes of `bits` bits; windows that only share a
    hash meet, but aren't equal for that.

    Null texts have no words. Documents without doc_id come after all others; documents of one doc_id are ordered by a
    hash of their texts, and rows that repeat in both are one document. Texts shorter than a window lose
    nothing. An empty table gives an empty table; other columns pass through, but for those named like a new one.
    """
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    homes = int(size // HOME_BYTES) + 8
    kept_columns = others(docs, "n_words", "n_removed", "kept")
    inside = {c: c if c in ("doc_id", "text") else f"column{i}" for i, c in enumerate(kept_columns)}  # names that clash with none

    def home(tie) -> Column:
        return F.pmod(F.xxhash64("doc_id", tie), F.lit(homes)).cast("int")

    homed = docs.select(*(F.col(c).alias(n) for c, n in inside.items()), F.xxhash64(text_or_empty()).alias("_tie"))
    homed = homed.withColumn("_home", home("_tie"))

    def anchors():
        def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, home_of, found = utf8(batch.column(1)), batch.column(0).to_numpy(), []
            for a, b in blocks(texts):
                w = Words(texts[a:b], bits)
                first, _, h = w.segments(window)
                found.append(np.stack([home_of[a:b][w.of[first]].astype(np.int64), h.view(np.int64)]))
            # repetitive texts have one anchor very often: counted here, not after a shuffle
            home, anchor = np.concatenate(found, axis=1)
            order = np.lexsort((home, anchor))
            home, anchor = home[order], anchor[order]
            new = np.flatnonzero(np.concatenate([[True], (home[1:] != home[:-1]) | (anchor[1:] != anchor[:-1])])[: len(home)])
            return pa.record_batch([pa.array(home[new].astype(np.int32)), pa.array(anchor[new]), pa.array(np.diff(np.append(new, len(home))))], ["home", "anchor", "n"])

        return of_batch

    seen = materialise(arrow_map(homed.select("_home", "text"), "home int, anchor bigint, n bigint", anchors), "anchors")
    often = seen.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    shared = materialise(seen.drop("n").join(often, "anchor").select("home", "anchor"), "shared")

    def segments_of(own: pa.Table, anchor: pa.Table) -> pa.Table:
        """Every segment of a home's documents whose anchor is shared."""
        wanted = np.unique(anchor["anchor"].to_numpy())
        own = once(own)
        row, start, count, place, segment = shared_segments(utf8(own["text"].combine_chunks()), wanted, window, bits, named=True)
        ids = own.select(["doc_id", "_tie"]).take(pa.array(row))
        return pa.table([ids["doc_id"], ids["_tie"], pa.array(start), pa.array(count), pa.array(wanted[place]), pa.array(segment, pa.binary())], SEGMENT)

    def words_of(own: pa.Table, part: pa.Table) -> pa.Table:
        """part with the words of its segments."""
        own = once(own)
        texts = utf8(own["text"].combine_chunks())
        of = by_document(part)
        start, windows_ = part["start"].to_numpy(), part["windows"].to_numpy()
        rows, words = [], []
        for text, key in zip(texts, zip(own["doc_id"].to_pylist(), own["_tie"].to_pylist(), strict=True), strict=True):
            if key in of:
                split = text.split()
                rows += of[key].tolist()
                words += [b" ".join(split[start[i] : start[i] + windows_[i] + window - 1]) for i in of[key]]
        return part.select(["anchor", "crowded", "doc_id", "tie", "start"]).take(pa.array(rows, pa.int64())).append_column("words", pa.array(words, pa.binary()))

    segment_schema = f"doc_id {kind}, tie bigint, start bigint, windows bigint, anchor bigint, segment binary"
    occurrences = homed.groupBy("_home").cogroup(shared.groupBy("home")).applyInArrow(segments_of, segment_schema)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie", "start")
    first = occurrences.groupBy("anchor", "segment").agg(F.min(F.struct(place.alias("at"), "windows")).alias("x"))
    parts = materialise(first.select("anchor", "x.at.doc_id", "x.at.tie", "x.at.start", "x.windows"), "parts")

    def several(rows: DataFrame) -> DataFrame:
        """rows whose anchor has others, with `crowded`: only windows of those can be shared by distinct ones."""
        counts = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return rows.join(counts.select("anchor", (F.col("n") > CROWD).alias("crowded")), "anchor")

    distinct = several(parts).withColumn("home", home("tie"))
    word_schema = f"anchor bigint, crowded boolean, doc_id {kind}, tie bigint, start bigint, words binary"
    worded = materialise(homed.groupBy("_home").cogroup(distinct.groupBy("home")).applyInArrow(words_of, word_schema), "words")

    def pieces_of(order: int | None):
        """Segments cut where the key of that order changes."""

        def make():
            def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
                w = Words(batch.column(3).to_pylist(), bits)
                at = w.windows(window)
                key, of = w.keys(at, window, order), w.of[at]
                new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])])[: len(at)])
                first, last = at[new], at[np.append(new[1:], len(at)) - 1] + window - 1
                text = [w.text[a:b] for a, b in zip(w.begin[first].tolist(), w.end[last].tolist(), strict=True)]
                row = pa.array(w.of[first])
                start = batch.column(2).to_numpy()[w.of[first]] + first - w.first[w.of[first]]
                return pa.record_batch([pa.array(key[new].view(np.int64)), *(batch.column(k).take(row) for k in (0, 1)), pa.array(start), pa.array(text, pa.binary())], ["anchor", "doc_id", "tie", "start", "words"])

            return of_batch

        return make

    cold, split = [worded.where("NOT crowded")], []
    crowd, orders = worded.where("crowded"), iter(ORDERS)
    while not crowd.isEmpty():
        pieces = arrow_map(crowd.select("doc_id", "tie", "start", "words"), f"anchor bigint, doc_id {kind}, tie bigint, start bigint, words binary", pieces_of(next(orders)))
        pieces = materialise(pieces, "pieces")
        earliest = materialise(pieces.groupBy("anchor", "words").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")), "earliest")
        # a piece of ever so many occurrences meets its first one in SALTS tasks
        salted = earliest.where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "tie", "start"), F.lit(SALTS)).cast("int")
        again = pieces.withColumn("salt", salt).join(salted, ["anchor", "words", "salt"]).where(place != F.col("at"))
        split.append(again.select("doc_id", "tie", "start", (F.col("start") + F.size(F.split(F.col("words").cast("string"), " "))).cast("bigint").alias("end")))
        left = materialise(several(earliest.select("anchor", "at.doc_id", "at.tie", "at.start", "words")), "left")
        cold.append(left.where("NOT crowded").select(worded.columns))
        crowd = left.where("crowded")

    shards = homes
    indexed = reduce(DataFrame.unionByName, cold).select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"), "doc_id", "tie", "start", "words")
    span_schema = f"doc_id {kind}, tie bigint, start bigint, end bigint"
    spans = reduce(DataFrame.unionByName, split, indexed.groupBy("shard").applyInArrow(lambda x: repeated_windows(x, window), span_schema))

    # what the last look at a home's documents needs: its shared anchors, the first places of segments, other spans
    def facts(df: DataFrame, what: int, **has: Column) -> DataFrame:
        columns = {"anchor": "bigint", "doc_id": kind, "tie": "bigint", "start": "bigint", "end": "bigint"}
        own = [has[c].alias(c) if c in has else F.lit(None).cast(t).alias(c) for c, t in columns.items()]
        return df.select((has["home"] if "home" in has else home("tie")).alias("home"), F.lit(what).cast("tinyint").alias("what"), *own)

    at_place = {c: F.col(c) for c in ("doc_id", "tie", "start")}
    known = facts(shared, 0, home=F.col("home"), anchor=F.col("anchor")).unionByName(facts(parts, 1, **at_place)).unionByName(facts(spans, 2, end=F.col("end"), **at_place))

    def cut(own: pa.Table, right: pa.Table) -> pa.Table:
        what = right["what"].to_numpy()
        wanted = np.unique(right.filter(pa.array(what == 0))["anchor"].to_numpy())
        single = once(own)
        keys = {k: i for i, k in enumerate(zip(single["doc_id"].to_pylist(), single["_tie"].to_pylist(), strict=True))}
        texts = utf8(single["text"].combine_chunks())
        row, start, count, _, _ = shared_segments(texts, wanted, window, bits)

        def place_of(table: pa.Table) -> np.ndarray:
            return np.array([keys[k] for k in zip(table["doc_id"].to_pylist(), table["tie"].to_pylist(), strict=True)], np.int64)

        # a segment that isn't the first of its like is a repeat as a whole
        firsts, more = right.filter(pa.array(what == 1)), right.filter(pa.array(what == 2))
        again = ~np.isin(row << 32 | start, place_of(firsts) << 32 | firsts["start"].to_numpy())
        row = np.concatenate([row[again], place_of(more)])
        start, end = np.concatenate([start[again], more["start"].to_numpy()]), np.concatenate([(start + count + window - 1)[again], more["end"].to_numpy()])
        order = np.argsort(row, kind="stable")
        ranges, bounds = np.stack([start, end], axis=1)[order], np.searchsorted(row[order], np.arange(len(texts) + 1))
        done = [keep(x, ranges[a:b] if b > a else None) for x, a, b in zip(texts, bounds, bounds[1:], strict=False)]
        rows = [done[keys[k]] for k in zip(own["doc_id"].to_pylist(), own["_tie"].to_pylist(), strict=True)]
        n, removed, left = zip(*rows, strict=True) if rows else ((), (), ())
        return own.drop_columns(["_tie", "_home"]).append_column("n_words", pa.array(n, pa.int64())).append_column("n_removed", pa.array(removed, pa.int64())).append_column("kept", pa.array(left, pa.string()))

    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for c, n in inside.items()), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")), T.StructField("kept", T.StringType())])
    done = homed.groupBy("_home").cogroup(known.groupBy("home")).applyInArrow(cut, schema)
    return done.toDF(*kept_columns, "n_words", "n_removed", "kept")


SEGMENT = ["doc_id", "tie", "start", "windows", "anchor", "segment"]
