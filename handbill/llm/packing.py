"""Best-fit packing: a configuration linear program over the histogram of lengths, rounded."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import arrow_map, numbered, prepare, ranks
from handbill.llm.tokens import GROUP_BYTES, byte_bpe_path, encoder_of

#: Share of the pieces that the program's patterns place, at least; best-fit has the rest.
PLACED = 0.9
#: Settings that are tried in turn until a plan is as good as any known: how hard lengths that lag pull; how much more a long
#: piece is worth than short ones of the same sum; how far under the best value a pattern may be to be taken for being
#: fuller; the share of what is left that a pattern may take at once; whether a length is used once a round.
SETTINGS = ((0.05, 4.0, 0.01, 0.97, False), (0.2, 1.0, 0.5, 0.5, True), (0.0, 4.0, 0.02, 0.9, False), (0.2, 4.0, 0.02, 0.9, False))

Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first


def price(worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most value of exactly c (-inf: no such sum), and a length in that.

    worth[l] is what one piece of length l is worth, 0 if there is none.
    """
    lengths = np.flatnonzero(worth[: capacity + 1] > 0)
    each, below = worth[lengths], np.searchsorted(lengths, np.arange(capacity + 1), "right")
    value, took = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, np.int64)
    value[0] = 0
    for c in range(1, capacity + 1):
        if n := below[c]:
            total = value[c - lengths[:n]] + each[:n]
            i = int(total.argmax())
            value[c], took[c] = total[i], lengths[i]
    return value, took


def lower_bound(counts: np.ndarray, worth: np.ndarray, value: np.ndarray) -> float:
    """What the dual solution worth / (most value of a pattern) proves: no packing, not even a fractional one, has fewer sequences."""
    return float((counts * worth[1:]).sum() / value.max())


def program(counts: np.ndarray, capacity: int, pull: float, bias: float, slack: float, share: float, once: bool) -> Iterator[tuple[dict[Pattern, int], np.ndarray, float]]:
    """The configuration program by multiplicative weights, in whole patterns: (patterns so far, pieces left, bound) after each round.

    A length's weight falls by exp(-pull) as its pieces are covered. A round prices all patterns by one dynamic program,
    then takes, for each length from the longest down, the fullest pattern through it whose value is within slack of the
    best. Where a round finds none, the slack doubles. Ends when all pieces are covered.
    """
    need, left, chosen = counts.astype(float), counts.astype(np.int64).copy(), {}
    size = np.arange(1, capacity + 1) / capacity
    bound = max(float((counts * size).sum()), float(counts[capacity // 2 :].sum()))
    while left.any():
        lengths = np.flatnonzero(left) + 1
        lag = left[lengths - 1] / need[lengths - 1]
        worth = np.zeros(capacity + 1)
        worth[lengths] = size[lengths - 1] * (1 + bias * size[lengths - 1]) * np.exp(pull * (lag - lag.min()))
        value, took = price(worth, capacity)
        if len(lengths) == np.count_nonzero(counts):
            bound = max(bound, lower_bound(counts, worth, value))
        enough, used, moved = (1 - slack) * value.max(), set(), False
        for length in lengths[::-1].tolist():
            if once and length in used:
                continue
            near = np.flatnonzero(worth[length] + value[: capacity - length + 1] >= enough)
            if not len(near):
                continue
            held, c = {length: 1}, int(near[-1])
            while c:
                held[int(took[c])] = held.get(int(took[c]), 0) + 1
                c -= int(took[c])
            if slack >= 1:  # nothing else moves: as many copies as there are
                held = {n: min(k, int(left[n - 1])) for n, k in held.items() if left[n - 1]}
            if any(k > left[n - 1] for n, k in held.items()) or length not in held or (once and used & held.keys()):
                continue
            times = max(1, int(min(share * left[n - 1] / k for n, k in held.items())))
            pattern = tuple(sorted(held.items(), reverse=True))
            chosen[pattern] = chosen.get(pattern, 0) + times
            for n, k in held.items():
                left[n - 1] -= k * times
            used |= held.keys()
            moved = True
        if moved:
            yield chosen, left, bound
        else:
            slack = min(1.0, 2 * slack)


def best_fit(chosen: dict[Pattern, int], left: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """chosen with the pieces that are left: longest first, each into the least gap that holds it, else into a new sequence."""
    by_free: dict[int, list[tuple[dict, int]]] = {}
    free: list[int] = []

    def put(gap: int, pattern: dict, times: int) -> None:
        if gap not in by_free:
            by_free[gap] = []
            insort(free, gap)
        by_free[gap].append((pattern, times))

    for pattern, times in chosen.items():
        put(capacity - sum(length * k for length, k in pattern), dict(pattern), times)
    for length in range(capacity, 0, -1):
        n = int(left[length - 1])
        while n:
            at = bisect_left(free, length)
            if at < len(free):
                gap = free[at]
                pattern, times = by_free[gap].pop()
                if not by_free[gap]:
                    del by_free[gap], free[at]
            else:
                gap, pattern, times = capacity, {}, 0
            k = min(gap // length, n)
            used = min(times, n // k) if times else n // k
            if times > used:
                put(gap, pattern, times - used)
            put(gap - k * length, {**pattern, length: pattern.get(length, 0) + k}, used)
            n -= k * used
    return [(tuple(sorted(p.items(), reverse=True)), t) for gap in by_free.values() for p, t in gap]


@dataclass
class Plan:
    """(pattern, how often) that hold exactly the pieces there are; the share of them that the program placed; a lower bound."""

    patterns: list[tuple[Pattern, int]]
    placed: float
    bound: float

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.patterns)


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """The fewest sequences found for counts[l - 1] pieces of each length l.

    For each setting the program runs until its patterns place PLACED of the pieces and a little more; of its last states
    the one is kept that best-fit completes with the fewest sequences. Settings are tried until a plan reaches the bound
    or best-fit's number. Best-fit's own patterns are columns of the program too: they stand only where pricing
    under every setting has found no plan of as few sequences (placed is then 0).
    Works on the histogram alone, so time and size depend on the capacity, not on the number of documents.
    """
    counts = counts.astype(np.int64)
    total = int(counts.sum())
    plain = Plan(best_fit({}, counts, capacity), 0.0, 0.0)
    best, bound = None, 0.0
    for setting in SETTINGS if total else ():
        for chosen, left, proved in program(counts, capacity, *setting):
            bound, placed = max(bound, proved), 1 - int(left.sum()) / total
            if placed >= PLACED:
                done = Plan(best_fit(chosen, left, capacity), placed, 0.0)
                if best is None or done.sequences < best.sequences:
                    best = done
            if placed >= PLACED + 0.05:
                break
        if best.sequences <= max(plain.sequences, int(np.ceil(bound - 1e-6))):
            break
    if best is None or best.sequences > plain.sequences:
        best = plain
    return Plan(best.patterns, best.placed, bound)


def table(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows of (length, first rank, copies a sequence, first sequence, offset in it), sorted: which sequence takes a rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, k in pattern:
            rank = taken.get(length, 0)
            rows.append((length, rank, k, sequence, offset))
            taken[length] = rank + k * times
            offset += k * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, path: str, capacity: int, end: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids with `end` after them.

    A document of more than capacity ids is cut into pieces of capacity ids, of which the first may be shorter.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        encoder = encoder_of(path)
        last = np.array([end], "<u4").tobytes()

        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, number, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                ids += last
                n = len(ids) // 4
                edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    row.append(i)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            return pa.record_batch(
                [batch.column(0).take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

        return cut

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return arrow_map(rows, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint", make, GROUP_BYTES // 2)


def pack(docs: DataFrame, path: str | None = None, capacity: int = 1024, end: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    The histogram of lengths (capacity numbers) goes to the driver, which solves the configuration linear
    program by multiplicative weights with knapsack pricing, in whole patterns, and completes it by best-fit. A piece's
    rank among those of its length says which sequence of which pattern takes it.

    Null texts count as empty: one piece that holds the end id alone. Rows that repeat, doc_id null or not, are packed
    each for itself. An empty table gives an empty table; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = numbered(pieces(docs, path or byte_bpe_path(), capacity, end), "length", "pieces")
    counts = np.zeros(capacity, np.int64)
    for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["length"] - 1] = r["n"]
    where = table(plan(counts, capacity).patterns)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        span = int(counts.max(initial=0)) + 1
        keys = where[:, 0] * span + where[:, 1]

        def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = where[np.searchsorted(keys, length * span + rank, "right") - 1]
            inside = rank - at[:, 1]
            sequence = at[:, 3] + inside // at[:, 2]
            offset = at[:, 4] + inside % at[:, 2] * length
            return pa.record_batch([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        return assign

    ranked = ranks(rows, "length").select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return arrow_map(ranked, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint", make)
