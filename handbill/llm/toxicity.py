"""Toxicity: a linear-chain conditional random field tags spans; its marginals make document scores."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import chain as chain_lists

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import arrow_map, prepare
from handbill.llm.quality import crc_mod, sample

TOKEN = re.compile(r"[^\W\d_]+")
#: What ends a sentence, and other ASCII characters that are no letters, as spaces; characters beyond ASCII that are no letters.
STOPS, ODD = b".!?\n", re.compile(r"(?:[^\w\x00-\x7f]|(?![\x00-\x7f])\d)")
PLAIN_TEXT = bytes(10 if i in STOPS else i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))
#: Tokens up to which sequences are tagged side by side, and of a block of a longer one; sentences are learnt from in
#: pieces of at most so many tokens.
BLOCK = 64
#: The most labelled documents that are fitted, about.
SAMPLE = 2_500
#: Tokens of a lot that is worked on at once.
CELLS = 1 << 17
#: Distinct tokens whose features a worker keeps.
KEPT = 300_000


def lowered(token: bytes) -> bytes:
    return token.lower() if token.isascii() else token.decode().lower().encode()


def features(token: bytes) -> list[bytes]:
    """The token in lower case, its beginnings and its end, in bytes."""
    token = lowered(token)
    out = [b"w:" + token]
    out += [b"%d:" % k + token[:k] for k in (3, 4, 5, 6) if len(token) > k]
    if len(token) > 3:
        out.append(b"s:" + token[-3:])
    return out


class Coded:
    """Texts as numbers: their distinct words in lower case, the words of each text, the lengths of its sentences.

    Words are held once and named by 4 bytes wherever they stand, their features likewise.
    """

    def __init__(self, texts: list[bytes]):
        place: dict[bytes, int] = {}
        self.docs: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        for text in texts:
            found = sequences_of(text.decode("utf-8", "replace"))
            self.docs.append(np.fromiter((place.setdefault(lowered(w), len(place)) for s in found for w in s), np.int32, sum(map(len, found))))
            self.sizes.append(np.array([len(s) for s in found], np.int32))
        names: dict[bytes, int] = {}
        feature, count = array("i"), array("i")
        for w in place:
            own = features(w)
            feature.extend(names.setdefault(f, len(names)) for f in own)
            count.append(len(own))
        self.n_words, self.names = len(place), list(names)
        #: the features of all words, those of one after those of another, and where each word's begin
        self.feature, self.count = np.array(feature, np.int32), np.array(count, np.int64)
        self.first = np.cumsum(self.count) - self.count

    def features_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The features of words, one word's after another's, and how many each has."""
        n = self.count[words]
        return self.feature[np.repeat(self.first[words] - np.cumsum(n) + n, n) + np.arange(n.sum())], n


def suspicious(coded: Coded, toxic: np.ndarray, least: int = 6, purity: float = 0.93) -> np.ndarray:
    """Which features mark a token of a toxic document as toxic.

    Labels are given for documents; this is how tokens get theirs. A feature marks if `purity` of its documents are
    toxic, and if it follows `least` different words there: copies of one toxic document repeat its words
    after the same ones.
    """
    with_it = np.zeros((2, len(coded.names)), np.int64)
    varied = np.zeros(len(coded.names), np.int64)
    pairs = [np.zeros(0, np.int64)]  # each word of a toxic document with the one before it, from 1, or 0
    for words, y in zip(coded.docs, toxic.tolist(), strict=True):
        with_it[y, np.unique(coded.features_of(np.unique(words))[0])] += 1
        if y and len(words):
            pairs.append(np.unique(np.append(0, words[:-1].astype(np.int64) + 1) * coded.n_words + words))
    pair, a = np.unique(np.concatenate(pairs)), 0
    while a < len(pair):  # all pairs of one word before are in one lot
        last = pair[min(a + CELLS, len(pair)) - 1] // coded.n_words
        lot = pair[a : (a := int(np.searchsorted(pair, (last + 1) * coded.n_words)))]
        found, n = coded.features_of(lot % coded.n_words)
        varied += np.bincount(np.unique(np.repeat(lot // coded.n_words, n) * len(varied) + found) % len(varied), minlength=len(varied))
    good, bad = with_it
    return (varied >= least) & (bad >= purity * (bad + good))


def forward_backward(emission: np.ndarray, step: np.ndarray, length: np.ndarray, weigh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of a two-state chain: P(tag 1) of each token, and expected pairs of tags, sequences weighed.

    emission: sequences x tokens, of tag 1 (tag 0: 0); step[i, j]: from tag i to tag j; sequences are padded beyond
    their length. Works in odds of tag 1 against tag 0: up to a token, and after it.
    """
    e, m = np.exp(np.clip(emission, -30, 30)).T, np.exp(step)
    most, n = e.shape
    inside = np.arange(most)[:, None] < length
    ahead, back = np.empty((most, n)), np.ones((most, n))
    ahead[0] = e[0]
    for t in range(1, most):
        ahead[t] = e[t] * (m[0, 1] + m[1, 1] * ahead[t - 1]) / (m[0, 0] + m[1, 0] * ahead[t - 1])
    for t in range(most - 2, -1, -1):
        x = e[t + 1] * back[t + 1]
        back[t] = np.where(inside[t + 1], (m[1, 0] + m[1, 1] * x) / (m[0, 0] + m[0, 1] * x), 1)
    odds = ahead * back
    a, x = ahead[:-1], (e * back)[1:]
    some = np.where(inside[1:], weigh, 0) / (m[0, 0] + m[0, 1] * x + m[1, 0] * a + m[1, 1] * a * x)
    pairs = m * [[some.sum(), (some * x).sum()], [(some * a).sum(), (some * a * x).sum()]]
    return np.where(inside, odds / (1 + odds), 0).T, pairs


class Emissions(dict):
    """Scores of tag 1 by token, worked out from features when a token is first seen."""

    def __init__(self, weights: dict[bytes, float], bias: float):
        super().__init__()
        self.weights, self.bias = weights, bias

    def __missing__(self, token: bytes) -> float:
        if len(self) > KEPT:
            self.clear()
        e = self[token] = self.bias + sum(self.weights.get(f, 0.0) for f in features(token))
        return e


@dataclass
class Tagger:
    """Weights of features for tag 1, steps between tags, and the calibration from marginals to a document."""

    weights: dict[bytes, float]
    bias: float
    step: np.ndarray
    calibration: tuple[float, float] = (0.0, 1.0)

    def marginals(self, docs: list[list[list[bytes]]], emissions: Emissions) -> tuple[np.ndarray, np.ndarray]:
        """P(tag 1) of every token of all documents, and where each document's begin; sequences of like length go together."""
        size = np.array([len(s) for d in docs for s in d], np.int64)
        total = int(size.sum())
        flat = np.fromiter(map(emissions.__getitem__, chain_lists.from_iterable(chain_lists.from_iterable(docs))), float, total)
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.chains(flat, size), ends[np.cumsum([0, *map(len, docs)])]

    def chains(self, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """P(tag 1) of every token from the emissions of sequences that stand one after the other."""
        first, out = np.cumsum(size) - size, np.zeros(len(flat))
        for own, most in buckets(size):
            inside = np.arange(most) < size[own][:, None]
            at = first[own][:, None] + np.minimum(np.arange(most), size[own][:, None] - 1)
            out[at[inside]] = forward_backward(flat[at], self.step, size[own], np.ones(len(own)))[0][inside]
        if len(own := np.flatnonzero(size > BLOCK)):
            at = np.repeat(first[own] - np.cumsum(size[own]) + size[own], size[own]) + np.arange(size[own].sum())
            out[at] = long_chains(flat[at], self.step, size[own])
        return out

    def scores(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The score of each document from the marginals of all its tokens: calibrated evidence."""
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a + b * evidence(p, bounds), -30, 30)))


def buckets(size: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Sequences of up to BLOCK tokens, of like length, the longest of each lot, in lots that bound the memory."""
    out = []
    for lo, hi in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, 32), (32, BLOCK)):
        own = np.flatnonzero((size > lo) & (size <= hi))
        out += [(x := own[a : a + CELLS // hi], int(size[x].max())) for a in range(0, len(own), CELLS // hi)]
    return out


def evidence(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each document minus the log-probability that no token is toxic, at most 12."""
    total = np.concatenate([[0.0], np.cumsum(-np.log1p(-np.minimum(p, 1 - 1e-6)))])
    return np.minimum(12.0, np.maximum(0.0, total[bounds[1:]] - total[bounds[:-1]]))


def long_chains(emission: np.ndarray, step: np.ndarray, length: np.ndarray) -> np.ndarray:
    """P(tag 1), as of forward_backward(), for sequences of any length that stand one after the other.

    Their blocks go side by side, each sequence's joined by products of their matrices.
    """
    n, m = -(-length // BLOCK), np.exp(step)
    first, start = np.cumsum(n) - n, np.cumsum(length) - length
    total = int(n.sum())
    spot = np.arange(len(emission)) + np.repeat(first * BLOCK - start, length)
    e = np.exp(np.clip(emission, -30, 30))
    a = np.empty((total * BLOCK, 2, 2))  # from the tag of the token before, times what the own tag emits
    a[:] = np.eye(2)
    a[spot, :, 0], a[spot, :, 1] = m[:, 0], m[:, 1] * e[:, None]
    a[first * BLOCK, :, 0], a[first * BLOCK, :, 1] = 1, e[start][:, None]
    a = a.reshape(total, BLOCK, 2, 2)
    whole = np.broadcast_to(np.eye(2), (total, 2, 2))
    for j in range(BLOCK):
        whole = whole @ a[:, j]
        whole /= whole.sum((1, 2), keepdims=True)
    ahead, back = np.empty((total, 2)), np.empty((total, 2))
    for lo, hi in zip(first.tolist(), (first + n).tolist(), strict=True):
        v = w = np.array([0.5, 0.5])
        for b in range(lo, hi):
            ahead[b], v = v, v @ whole[b]
            v = v / v.sum()
        for b in range(hi - 1, lo - 1, -1):
            back[b], w = w, whole[b] @ w
            w = w / w.sum()
    before, after = np.empty((total, BLOCK, 2)), np.empty((total, BLOCK, 2))
    for j in range(BLOCK):
        ahead = (ahead[:, None, :] @ a[:, j])[:, 0]
        before[:, j] = ahead = ahead / ahead.sum(1, keepdims=True)
    for j in range(BLOCK - 1, -1, -1):
        after[:, j] = back
        back = (a[:, j] @ back[:, :, None])[:, :, 0]
        back /= back.sum(1, keepdims=True)
    p = before * after
    return (p[:, :, 1] / p.sum(2)).ravel()[spot]


def sequences_of(text: str) -> list[list[bytes]]:
    """Sentences as words in UTF-8, as they stand: TOKEN finds the same ones in the text."""
    if not text.isascii():
        text = ODD.sub(" ", text)
    found = [s.split() for s in text.encode("utf-8", "replace").translate(PLAIN_TEXT).split(b"\n")]
    return [s for s in found if s]


def fit(texts: list[bytes], toxic: np.ndarray, rounds: int = 40, decay: float = 2e-6) -> Tagger:
    """Token labels from document labels, then maximum likelihood of the chain by Adam on whole batches.

    Without labels of both kinds there is nothing to tag: every score is then 0.5 (no labels) or near the only one.
    """
    coded = Coded(texts)
    marks = suspicious(coded, toxic)
    own = np.repeat(np.arange(coded.n_words), coded.count)
    marked = np.bincount(own, marks[coded.feature], coded.n_words) > 0
    # every sequence, equal ones once and weighed: 4 bytes for each word, then one for each tag
    tagged: Counter = Counter()
    for words, sizes, y in zip(coded.docs, coded.sizes, toxic, strict=True):
        tags, end = marked[words] & bool(y), 0
        for n in sizes.tolist():
            start, end = end, end + n
            for a in range(start, end, BLOCK):
                b = min(a + BLOCK, end)
                tagged[words[a:b].tobytes() + tags[a:b].tobytes()] += 1
    tagger = Tagger({}, -6.0, np.zeros((2, 2)))
    n_toxic = int(toxic.sum())
    if not len(toxic) or n_toxic in (0, len(toxic)) or not tagged:
        tagger.calibration = (0.0 if not len(toxic) else 4.0 if n_toxic else -4.0, 0.0)
        return tagger
    size, weigh = np.array([len(x) // 5 for x in tagged]), np.array(list(tagged.values()), float)
    first = np.cumsum(size) - size
    word = np.frombuffer(b"".join(x[: len(x) // 5 * 4] for x in tagged), np.int32)
    tags = np.frombuffer(b"".join(x[len(x) // 5 * 4 :] for x in tagged), np.int8)
    del tagged
    count = np.bincount(coded.feature, np.bincount(word, minlength=coded.n_words)[own], len(coded.names))
    frequent = sorted(np.flatnonzero(count >= 3).tolist(), key=coded.names.__getitem__)
    number = np.full(len(coded.names), -1)
    number[frequent] = np.arange(len(frequent))
    held = number[coded.feature] >= 0
    owner, feature = own[held], number[coded.feature[held]]
    lots = buckets(size)

    def padded(rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the tokens of a lot are, and which of these are no padding."""
        return first[rows][:, None] + np.minimum(np.arange(most), size[rows][:, None] - 1), np.arange(most) < size[rows][:, None]

    pairs_seen = np.zeros(4)
    for rows, most in lots:
        at, inside = padded(rows, most)
        pairs_seen += np.bincount((2 * tags[at[:, :-1]] + tags[at[:, 1:]])[inside[:, 1:]], np.repeat(weigh[rows], size[rows] - 1), 4)
    pairs_seen = pairs_seen.reshape(2, 2)
    theta = [np.zeros(len(frequent)), np.array([-4.0]), np.zeros((2, 2))]
    m, v = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    scale = 1 / weigh.sum()
    for t in range(1, rounds + 1):
        emission = theta[1] + np.bincount(owner, theta[0][feature], coded.n_words)
        off, pairs = np.zeros(coded.n_words), np.zeros((2, 2))
        for rows, most in lots:
            at, inside = padded(rows, most)
            q, joint = forward_backward(emission[word[at]], theta[2], size[rows], weigh[rows])
            off += np.bincount(word[at[inside]], ((q - tags[at]) * weigh[rows][:, None])[inside], coded.n_words)
            pairs += joint
        grads = [np.bincount(feature, off[owner], len(frequent)) * scale + decay * theta[0], np.array([off.sum() * scale]), (pairs - pairs_seen) * scale + decay * theta[2]]
        for x, g, mm, vv in zip(theta, grads, m, v, strict=True):
            mm += 0.1 * (g - mm)
            vv += 0.001 * (g * g - vv)
            x -= 0.25 * (mm / (1 - 0.9**t)) / (np.sqrt(vv / (1 - 0.999**t)) + 1e-8)
    theta[0][np.abs(theta[0]) <= 1e-3] = 0
    tagger.weights = {coded.names[f]: float(x) for f, x in zip(frequent, theta[0].tolist(), strict=True) if x}
    tagger.bias, tagger.step = float(theta[1][0]), theta[2]
    emission = tagger.bias + np.bincount(owner, theta[0][feature], coded.n_words)
    found = [evidence(tagger.chains(emission[x], n), np.array([0, len(x)])) for x, n in zip(coded.docs, coded.sizes, strict=True)]
    tagger.calibration = logistic(np.concatenate(found), toxic)
    return tagger


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """a, b of P = 1 / (1 + exp(-a - b x)), by Newton steps with a small ridge."""
    d = np.stack([np.ones(len(x)), x], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        h = d.T @ (d * (p * (1 - p))[:, None]) + 0.5 * np.eye(2)
        w += np.linalg.solve(h, d.T @ (y - p) - 0.5 * w)
    return float(w[0]), float(w[1])


def offsets(text: str, p: np.ndarray, least: float) -> list[dict]:
    """Character spans [begin, end) of tokens of a marginal of at least that; neighbours in a row are one span."""
    out: list[dict] = []
    before = -2
    for i, match in enumerate(TOKEN.finditer(text)):
        if i < len(p) and p[i] >= least:
            if before == i - 1:
                out[-1] |= {"end": match.end(), "marginal": max(out[-1]["marginal"], float(p[i]))}
            else:
                out.append({"begin": match.start(), "end": match.end(), "marginal": float(p[i])})
            before = i
    return out


def tag(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, least: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted and spans (array of begin, end, marginal) of every whole text.

    The tagger is fitted on the driver, on about `most` labelled documents at most, of those whose fold is not
    0. The executors tag every sentence of every document; spans are character offsets.

    Null and empty texts have no tokens: they get the score of a document without toxic ones, and no spans. Rows that repeat get
    equal scores. Null doc_ids are of fold 0 and never learnt from. An empty table gives an empty table; other columns are not read.
    """
    prepare(docs.sparkSession)
    tagger = fit(*sample(docs, labels, "toxic", crc_mod(5) != 0, most))
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<begin: int, end: int, marginal: double>>"
    span_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def make():
        emissions = Emissions(tagger.weights, tagger.bias)

        def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            p, bounds = tagger.marginals([sequences_of(x) for x in texts], emissions)
            scores = tagger.scores(p, bounds)
            own = [p[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            found = [offsets(x, mine, least) if len(mine) and mine.max() >= least else [] for x, mine in zip(texts, own, strict=True)]
            return pa.record_batch([batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(found, span_type)], ["doc_id", "held_out", "score", "predicted", "spans"])

        return of_batch

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (crc_mod(5) == 0).alias("held_out"))
    return arrow_map(rows, f"doc_id {kind}, held_out boolean, score double, predicted int, spans {spans}", make)


def filter_toxic(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """docs without those whose score is 0.5 or more; all columns stay, rows that repeat stay or go together.

    Null and empty texts have the score of a document without toxic ones, and stay unless nearly all labelled documents
    are toxic. Null doc_ids stay by their texts like any other. An empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    tagger = fit(*sample(docs, labels, "toxic", crc_mod(5) != 0, most))

    def make():
        emissions = Emissions(tagger.weights, tagger.bias)

        def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            scores = tagger.scores(*tagger.marginals([sequences_of(x or "") for x in texts], emissions))
            return batch.filter(pa.array(scores < 0.5))

        return of_batch

    return arrow_map(docs, docs.schema, make)
