"""Runs of words: maximal stretches with a period, from a dictionary of basic factors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handbill.llm.common import WORD, arrow_map, fresh, others, prepare, text_or_empty, utf8

#: Words of the shortest run.
LEAST = 12
#: Words of the texts that share a dictionary; a longer text has one of its own.
BLOCK_WORDS = 1 << 16

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def dictionary(codes: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, ... codes at each place; equal factors, and only they, have equal names.

    Factors that occur once, or don't fit, are named by their own place, below zero: nothing longer that holds them occurs again, so
    only the others are named anew. The dictionary ends before the first length without any repeat.
    """
    n, levels, length = len(codes), [], 1
    _, names, counts = np.unique(codes, return_inverse=True, return_counts=True)
    names = names.astype(np.int64)
    alone = counts[names] == 1
    names[alone] = -1 - np.flatnonzero(alone)
    live = np.flatnonzero(~alone)
    while len(live):
        levels.append(names)
        live = live[live + 2 * length <= n]
        live = live[names[live + length] >= 0]
        key = names[live] * np.int64(n + 1) + names[live + length]
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])[: len(order)])
        size = np.diff(np.append(new, len(order)))
        of = np.repeat(np.arange(len(new)), size)
        names = -1 - np.arange(n, dtype=np.int64)
        again = np.repeat(size, size) > 1
        names[live[order[again]]] = of[again]
        live = np.flatnonzero(names >= 0)
        length *= 2
    return levels


def proposals(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): of the factors of `length`, periods from length to below twice it that occurrences propose.

    Occurrences of a factor whose next one is at most half its length away form one progression, whose difference is the factor's own
    period. Two occurrences of one progression lie in a run of that shorter period; between two progressions the distances
    are a progression again, and every one of them stands for itself, by the first pair of places that has it.
    """
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    if not len(at):
        return at, at
    gap, same = np.diff(at), np.diff(names[at]) == 0
    new = np.concatenate([[True], ~same | (2 * gap > length)])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    first, last = at[begin], at[begin + size - 1]
    step = np.where(size > 1, (last - first) // np.maximum(size - 1, 1), 1)
    name = names[first]
    places, periods = [], []
    for ahead in (1, 2, 3):  # progressions are over half a length apart, so that a fourth one is too far
        a = np.arange(len(first) - ahead)
        b = a + ahead
        near = (name[a] == name[b]) & (first[b] - last[a] < 2 * length)
        a, b = a[near], b[near]
        least, d = first[b] - last[a], np.where(size[a] > 1, step[a], step[b])
        lo = np.maximum(0, -((least - length) // d))
        hi = np.minimum(size[a] + size[b] - 2, (2 * length - 1 - least) // d)
        count = np.maximum(0, hi - lo + 1)
        pair = np.repeat(np.arange(len(a)), count)
        t = lo[pair] + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        # t steps more than the least distance: as many as possible by an earlier start, the others by a later end
        back = np.minimum(t, size[a][pair] - 1)
        places.append(last[a][pair] - back * d[pair])
        periods.append(least[pair] + t * d[pair])
    return np.concatenate(places), np.concatenate(periods)


def extended(levels: list[np.ndarray], i: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest stretch around place i that repeats itself q further on."""
    n = len(levels[0])
    forth, back = np.zeros_like(i), np.zeros_like(i)
    for names, length in zip(reversed(levels), [1 << k for k in range(len(levels))][::-1], strict=True):  # no two factors twice as long as the first are equal
        at = np.minimum(i + forth, n - 1 - q)
        forth += length * ((at == i + forth) & (names[at] == names[at + q]))
        at = np.maximum(i - back - length, 0)
        back += length * ((at == i - back - length) & (names[at] == names[at + q]))
    return i - back, i + q + forth


def runs(codes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs of at least `least` codes and two periods, by start, then period.

    A run of period q holds two occurrences, q apart, of the factor that begins it and is as long as the greatest power of two
    up to q; they are of two progressions, or the run had a shorter period. So every run is proposed, and extending it
    gives it whole. What is proposed with a multiple of its period is the same stretch, of which the least period stays.
    """
    levels = dictionary(codes)
    found = [np.zeros((0, 3), np.int64)]
    for k, names in enumerate(levels):
        i, q = proposals(names, 1 << k)
        start, end = extended(levels, i, q)
        good = (end - start >= 2 * q) & (end - start >= least)
        found.append(np.unique(np.stack([start[good], end[good], q[good]], axis=1), axis=0))
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.concatenate([[True], (every[1:, :2] != every[:-1, :2]).any(axis=1)])[: len(every)]
    every = every[new]
    every[:, 1] -= every[:, 0]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def text_runs(texts: list[bytes], least: int = LEAST) -> list[tuple[list[bytes], np.ndarray]]:
    """The words of each text and its runs. Texts share dictionaries, in which words of different texts differ."""
    split = [t.split() for t in texts]
    out, a = [], 0
    while a < len(split):
        b, held = a + 1, len(split[a])
        while b < len(split) and held + len(split[b]) <= BLOCK_WORDS:
            held += len(split[b])
            b += 1
        codes, at, used = [], np.zeros(b - a + 1, np.int64), 0
        for k, words in enumerate(split[a:b]):
            own: dict[bytes, int] = {}
            codes.append(np.array([own.setdefault(w, used + len(own)) for w in words] + [used + len(own)], np.int64))  # the last one ends the text
            used += len(own) + 1
            at[k + 1] = at[k] + len(words) + 1
        every = runs(np.concatenate(codes), least)
        bounds = np.searchsorted(every[:, 0], at)
        for k in range(b - a):
            mine = every[bounds[k] : bounds[k + 1]].copy()
            mine[:, 0] -= at[k]
            out.append((split[a + k], mine))
        a = b
    return out


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words that no run covers after its first period."""
    if not len(found):
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]


def collapse_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """docs with runs (array of start, length, period by start, then period) and collapsed, the words left joined by one space.

    A run is a stretch of words with smallest period q, of at least `least` words and two periods, that neither neighbour
    extends. After its first q words its words are dropped. Runs may overlap: a word stays if none drops it.

    Null texts are empty ones: no runs, nothing left. Texts of any length are worked on whole, in a task of their row; rows
    that repeat are worked on each. An empty table gives an empty table; other columns pass through, but for those named like
    a new one.
    """
    prepare(docs.sparkSession)
    kept, mark = others(docs, "runs", "collapsed"), fresh(docs, "whole_text")
    rows = docs.select(*kept, text_or_empty(text).alias(mark))

    def make():
        def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
            done = text_runs(utf8(batch.column(batch.num_columns - 1)), least)
            sizes = np.array([len(found) for _, found in done])
            flat = np.concatenate([found for _, found in done])
            each = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=RUN.names)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), each)
            left = pa.array([b" ".join(collapsed(*x)).decode() for x in done], pa.string())
            return pa.record_batch([*batch.columns[:-1], lists, left], [*batch.schema.names[:-1], "runs", "collapsed"])

        return of_batch

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    return arrow_map(rows, schema, make)


def digest(found: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and digests of all runs and of the words left."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs; every tenth text, by the CRC-32 of its doc_id, has a stretch of its words repeated from one of them on.

    One step after the other, so that words are taken apart once.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    rows = rows.select("doc_id", "text", "g", "words", F.size("words").cast("bigint").alias("n"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    places = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    repeated = F.array_join(F.transform(places, lambda i: F.get("words", i.cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))
