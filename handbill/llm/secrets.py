"""Secret scans: patterns, and probabilistic automata that are inferred from what the patterns find."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handbill.llm.common import arrow_map, fresh, materialise, others, prepare, text_or_empty

# The patterns of labelled credentials, by kind, and how long what counts has to be.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # of the whole, at least 16
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8
#: The kind of spans that the automata add.
FORMAT = "format"
#: What automata are asked about: 8 or more letters, digits and signs, not ending in a dot.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{6,}[A-Za-z0-9+/_-]={0,2}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
#: What ordinary candidates are told apart by, so that what is rare has an automaton of its own.
SHAPES = ("letters", "capitals", "digits")
DIGIT = re.compile("[0-9]")
#: Words that a task remembers, at most, before it starts anew.
KNOWN = 1 << 19
#: Distinct values that an automaton is inferred from, at most: those of least hash among all.
SAMPLE = 2_000
#: Confidence of the tests that keep states apart.
ALPHA = 0.05
#: Natural logarithm of how many times likelier a credential's format must be than ordinary text.
MARGIN = 14.0

CODE = np.full(256, len(ALPHABET), np.int64)
CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))


class Automaton:
    """A probabilistic automaton over characters, inferred from a sample by merging states of its prefix tree.

    States are merged where no test tells them apart: the shares of each next character, and of the end, must agree within
    Hoeffding's bound, and so on down the tree. Each state keeps counts of its characters.
    """

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.edge: list[dict[str, int]] = [{}]
        self.ends, self.seen = [0], [0]
        for value in sorted(values):
            at = 0
            self.seen[0] += 1
            for c in value:
                if c not in self.next[at]:
                    self.next[at][c], self.edge[at][c] = len(self.next), 0
                    for column, empty in ((self.next, {}), (self.edge, {}), (self.ends, 0), (self.seen, 0)):
                        column.append(empty)
                self.edge[at][c] += 1
                at = self.next[at][c]
                self.seen[at] += 1
            self.ends[at] += 1
        self.width = (0.5 * np.log(2 / alpha)) ** 0.5
        self.states = self.merged()
        self.compile()

    def alike(self, a: int, b: int) -> bool:
        """Whether nothing below b, the root of a tree, differs from what is below a."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.seen[a], self.seen[b]
            bound = self.width * (n**-0.5 + m**-0.5)
            if bound >= 1 and m == 1:  # no share can differ by more, here or where b goes on
                continue
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.edge[a].keys() | self.edge[b].keys():
                if abs(self.edge[a].get(c, 0) / n - self.edge[b].get(c, 0) / m) > bound:
                    return False
            pairs += [(self.next[a][c], self.next[b][c]) for c in self.next[b] if c in self.next[a]]
        return True

    def fold(self, a: int, b: int) -> None:
        """Adds the tree at b to what is at a."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            self.ends[a] += self.ends[b]
            self.seen[a] += self.seen[b]
            for c, child in self.next[b].items():
                self.edge[a][c] = self.edge[a].get(c, 0) + self.edge[b][c]
                if c in self.next[a]:
                    pairs.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def merged(self) -> list[int]:
        """States that are kept: the likeliest state beside them is folded into the first that it is alike, or kept."""
        kept = [0]
        while True:
            beside = [(self.seen[t], a, c, t) for a in kept for c, t in self.next[a].items() if t not in kept]
            if not beside:
                return kept
            _, a, c, state = max(beside, key=lambda x: (x[0], -x[1], x[2]))
            for old in kept:
                if self.alike(old, state):
                    self.next[a][c] = old
                    self.fold(old, state)
                    break
            else:
                kept.append(state)

    def compile(self) -> None:
        """Tables by state and character: the next state, the logarithm of its share; a character not seen there stays, with a small share."""
        place = {s: k for k, s in enumerate(self.states)}
        size, letters = len(self.states), len(ALPHABET) + 1
        self.to = np.repeat(np.arange(size)[:, None], letters, axis=1)
        count, end = np.zeros((size, letters)), np.zeros(size)
        for k, s in enumerate(self.states):
            end[k] = self.ends[s]
            for c, t in self.next[s].items():
                symbol = CODE[ord(c)] if ord(c) < 256 else len(ALPHABET)
                count[k, symbol] += self.edge[s][c]
                self.to[k, symbol] = place[t]
        spread = 1 / (letters + 1)
        total = count.sum(axis=1) + end + 1
        self.log, self.log_end = np.log((count + spread) / total[:, None]), np.log((end + spread) / total)

    def score(self, values: list[str]) -> np.ndarray:
        """The logarithm of each value's probability, all values a character at a time."""
        size = np.array([len(v) for v in values], np.int64)
        flat = CODE[np.frombuffer("".join(values).encode("latin-1", "replace"), np.uint8)]
        begin = np.cumsum(size) - size
        out, state = np.zeros(len(values)), np.zeros(len(values), np.int64)
        order = np.argsort(-size, kind="stable")
        left = np.searchsorted(-size[order], -np.arange(int(size.max(initial=0))), "left")
        for k, n in enumerate(left.tolist()):
            own = order[:n]
            symbol = flat[begin[own] + k]
            out[own] += self.log[state[own], symbol]
            state[own] = self.to[state[own], symbol]
        return out + self.log_end[state]


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, place of its kind, credential) of what the patterns find, by start, then kind."""
    found = [(m.start(), m.end(), 0, m.group(1)) for m in ASSIGN.finditer(text) if len(m.group(1)) >= LEAST_VALUE]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        found += [(m.start(), m.end(), kind, m.group()) for m in pattern.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Stretches that may be credentials, beside all spans that are taken."""
    if not taken:
        yield from ((m.start(), m.end(), m.group()) for m in CANDIDATE.finditer(text))
        return
    at = 0
    for start, end in [*((t[0], t[1]) for t in taken), (len(text), len(text))]:
        if start > at:
            yield from ((m.start(), m.end(), m.group()) for m in CANDIDATE.finditer(text, at, start))
        at = max(at, end)


class Scanner:
    """Looks at texts one after the other; words seen before are not taken apart again."""

    def __init__(self):
        self.known: set[str] = set()

    def look(self, text: str) -> tuple[list[tuple[int, int, int, str]], set[str], set[str]]:
        """(what the patterns find, all words, those not seen before).

        No pattern matches without a colon, an equals sign, its own prefix or a long word, and none but the first reaches
        over white space.
        """
        words = set(text.split())
        if ":" in text or "=" in text or "AKIA" in text or max(map(len, words), default=0) >= 32:
            taken = base_spans(text)
        else:
            taken = []
        if len(self.known) > KNOWN:
            self.known = set()
        new = words - self.known
        self.known |= new
        return taken, words, new


def shape(value: str) -> int:
    return 2 if DIGIT.search(value) else int(value.isupper())


def least(values: set[str], most: int) -> list[tuple[int, str]]:
    """The values of least hash, with it (a bit less than 64, so that it is a signed number)."""
    return sorted((xxhash.xxh64_intdigest(v.encode()) >> 1, v) for v in values)[:most]


def sample(docs: DataFrame, most: int = SAMPLE) -> dict[str, list[str]]:
    """For each kind, and for ordinary text by SHAPES, the `most` distinct values of least hash in all texts.

    Each task keeps that many of each, so what is shuffled grows with tasks, not with texts.
    """
    prepare(docs.sparkSession)
    names = (*KINDS, *SHAPES)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict[str, int]] = [{} for _ in names]
        scanner = Scanner()
        for batch in batches:
            found: list[set[str]] = [set() for _ in names]
            for text in batch.column(0).to_pylist():
                taken, _, new = scanner.look(text)
                for _, _, kind, value in taken:
                    found[kind].add(value)
                for part in [text] if taken else new:
                    for _, _, v in candidates(part, taken):
                        found[len(KINDS) + shape(v)].add(v)
            for k, values in enumerate(found):
                ranked = least(values - kept[k].keys(), most)
                kept[k] = dict(sorted([*kept[k].items(), *((v, h) for h, v in ranked)], key=lambda x: x[1])[:most])
        for k, values in enumerate(kept):
            yield pa.record_batch([pa.array([k] * len(values), pa.int32()), pa.array(list(values.values()), pa.int64()), pa.array(list(values), pa.string())], ["kind", "h", "value"])

    found = materialise(docs.select(text_or_empty()).mapInArrow(gather, "kind int, h bigint, value string").distinct(), "values")
    each = [found.where(F.col("kind") == k).orderBy("h", "value").limit(most) for k in range(len(names))]
    out: dict[str, list[str]] = {k: [] for k in names}
    for r in reduce(DataFrame.unionByName, each).collect():
        out[names[r["kind"]]].append(r["value"])
    return out


class Model:
    """Automata of the kinds of credentials, and of the shapes of ordinary text."""

    def __init__(self, values: dict[str, list[str]]):
        self.kinds = {k: Automaton(values[k]) for k in KINDS if values.get(k)}
        self.ordinary = [Automaton(values.get(k) or [""]) for k in SHAPES]

    def margins(self, values: list[str]) -> tuple[np.ndarray, list[str]]:
        """By how much the likeliest format's logarithm is over that of ordinary text's likelier shape, and that format."""
        if not self.kinds or not values:
            return np.full(len(values), -np.inf), [""] * len(values)
        scores = np.stack([a.score(values) for a in self.kinds.values()])
        names = list(self.kinds)
        return scores.max(axis=0) - np.stack([a.score(values) for a in self.ordinary]).max(axis=0), [names[k] for k in scores.argmax(axis=0)]


def fit(docs: DataFrame, most: int = SAMPLE) -> Model:
    """Automata from the credentials that the patterns find in docs, which are the labels, at most `most` of a kind."""
    return Model(sample(docs, most))


SPAN = "struct<kind: string, start: bigint, end: bigint, format: string, margin: double>"


def find_secrets(docs: DataFrame, model: Model | None = None, margin: float = MARGIN) -> DataFrame:
    """docs with secrets: an array of kind, start, end (in characters, end exclusive), format, margin, by start, then kind.

    What the patterns find always stays (format and margin null). Beside these spans, each stretch of 8 or more letters, digits and signs
    is scored by all automata; where the likeliest format is `margin` (a natural logarithm) likelier than ordinary
    text, it is added with the kind FORMAT and the format's name. Without a model one is fitted on docs.

    Null texts are empty; texts are scanned whole; rows that repeat are scanned each; where no credential was labelled only the
    patterns count. An empty table gives an empty table; other columns pass through, but for one named secrets.
    """
    prepare(docs.sparkSession)
    model = fit(docs) if model is None else model
    kept, mark = others(docs, "secrets"), fresh(docs, "whole_text")
    rows = docs.select(*kept, text_or_empty().alias(mark))

    def make():
        scanner, hot, hot_words = Scanner(), {}, set()

        def judge(values: set[str]) -> dict[str, tuple[float, str]]:
            known = sorted(values)
            gains, formats = model.margins(known)
            return {known[k]: (float(gains[k]), formats[k]) for k in np.flatnonzero(gains >= margin)}

        def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, looks, pairs = batch.column(batch.num_columns - 1).to_pylist(), [], []
            asked: set[str] = set()
            for text in texts:
                taken, words, new = scanner.look(text)
                looks.append((taken, words))
                pairs += [(v, word) for word in new for _, _, v in candidates(word, [])]
                if taken:  # spans may cut words
                    asked.update(v for _, _, v in candidates(text, taken))
            hot.update(judge(asked | {v for v, _ in pairs}))
            hot_words.update(word for v, word in pairs if v in hot)
            spans = []
            for text, (taken, words) in zip(texts, looks, strict=True):
                own = [(start, kind, end, None, None) for start, end, kind, _ in taken]
                if taken or not hot_words.isdisjoint(words):
                    own += [(start, len(KINDS), end, hot[v][1], hot[v][0]) for start, end, v in candidates(text, taken) if v in hot]
                spans.append(own)
            names = (*KINDS, FORMAT)
            lists = [[{"kind": names[k], "start": s, "end": e, "format": f, "margin": g} for s, k, e, f, g in sorted(x, key=lambda y: y[:3])] for x in spans]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("format", pa.string()), ("margin", pa.float64())]))
            return pa.record_batch([*batch.columns[:-1], pa.array(lists, kind)], [*batch.schema.names[:-1], "secrets"])

        return of_batch

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("secrets", T.ArrayType(T._parse_datatype_string(SPAN)))])
    return arrow_map(rows, schema, make)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, spans of each base kind, the digest of all base spans, and all spans as one text."""

    def of_kind(kind: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"] == kind)

    base = F.filter("secrets", lambda s: s["kind"] != FORMAT)
    counts = [F.size(of_kind(k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))
