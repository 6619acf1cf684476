"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import arrow_map, prepare, utf8

#: Bytes of a chunk, and of a chunk that the next one doesn't share; bytes a filter sees, and its stride.
CHUNK, STEP, KERNEL, STRIDE = 256, 192, 8, 4
#: Numbers a byte is embedded in, filters, hidden units.
EMBED, FILTERS, HIDDEN = 6, 16, 16
#: The most labelled documents that are fitted, about; passes over them.
SAMPLE, EPOCHS = 2_500, 6


def crc_mod(n: int) -> Column:
    """crc32 of doc_id as text, modulo n: the fold of a document. Null doc_ids have fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks (n x CHUNK) that cover the whole text; zeros fill up the last."""
    n = max(1, -(-(len(text) - (CHUNK - STEP)) // STEP))
    flat = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    flat[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::STEP]


@dataclass
class Network:
    """bytes -> embedding -> filters -> most over a chunk -> mean and most over chunks -> hidden -> probability."""

    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # KERNEL * EMBED x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # 3 * FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int) -> Network:
        r = np.random.default_rng(seed)
        sizes = [((256, EMBED), 0.5), ((KERNEL * EMBED, FILTERS), 0.2), ((FILTERS,), 0), ((3 * FILTERS, HIDDEN), 0.2), ((HIDDEN,), 0), ((HIDDEN,), 0.3), ((1,), 0)]
        return cls(*[(r.standard_normal(s) * k).astype(np.float32) for s, k in sizes])

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def tables(self) -> np.ndarray:
        """What each byte at each place of the kernel adds to each filter: embedding and filters in one."""
        return np.stack([self.embed @ self.filters[j * EMBED : (j + 1) * EMBED] for j in range(KERNEL)])

    @staticmethod
    def responses(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Filters at every place of each chunk: (chunks, places, FILTERS)."""
        last = CHUNK - KERNEL + 1
        out = tables[0][x[:, 0:last:STRIDE]]
        for j in range(1, KERNEL):
            out += tables[j][x[:, j : j + last : STRIDE]]
        return out

    def pooled(self, x: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The most of each filter over each chunk, in blocks of chunks."""
        out = np.empty((len(x), FILTERS), np.float32)
        for a in range(0, len(x), 64):
            out[a : a + 64] = self.responses(tables, x[a : a + 64]).max(1)
        return np.maximum(out + self.bias, 0)

    def summary(self, pooled: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean, most and least over each document's chunks, which begin at `first`."""
        n = np.diff(np.append(first, len(pooled)))[:, None]
        return np.concatenate([np.add.reduceat(pooled, first) / n, np.maximum.reduceat(pooled, first), np.minimum.reduceat(pooled, first)], axis=1)

    def top(self, s: np.ndarray) -> np.ndarray:
        z = np.maximum(s @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        parts = [chunks(t) for t in texts]
        first = np.cumsum([0, *map(len, parts[:-1])])
        tables = self.tables()
        pooled = np.concatenate([self.pooled(p, tables) for p in joined(parts)])
        return self.top(self.summary(pooled, first))


def joined(parts: list[np.ndarray], most: int = 512) -> list[np.ndarray]:
    """Chunks of several documents together, and those of long ones in blocks."""
    out, held = [], []
    for p in parts:
        if len(p) > most:
            out += [np.concatenate(held)] if held else []
            out += [p[a : a + most] for a in range(0, len(p), most)]
            held = []
        else:
            held.append(p)
            if sum(map(len, held)) > most:
                out.append(np.concatenate(held))
                held = []
    return out + ([np.concatenate(held)] if held else [])


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1, steps: int = 64) -> Network:
    """Adam on log loss, classes weighed alike at half strength; gradients go through where each maximum was.

    An epoch has about `steps` batches, of 16 to 512 chunks.
    """
    net, r = Network.fresh(seed), np.random.default_rng(seed)
    if len(texts) == 0 or len(set(labels.tolist())) < 2:
        net.out[:] = 0
        net.out_bias[:] = 0 if len(texts) == 0 else (4 if labels[0] else -4)
        return net
    m, v, t = [np.zeros_like(p) for p in net.params()], [np.zeros_like(p) for p in net.params()], 0
    weight = np.where(labels == 1, 1, np.sqrt((labels == 1).sum() / (labels == 0).sum())).astype(np.float32)
    total = epochs * sum(len(x) for x in texts)
    batch_chunks = min(512, max(16, total // epochs // STEP // steps))
    seen = 0
    for _ in range(epochs):
        order, at = r.permutation(len(texts)), 0
        while at < len(order):
            own, parts = [], []
            while at < len(order) and (not parts or sum(map(len, parts)) < batch_chunks):
                own.append(order[at])
                parts.append(chunks(texts[order[at]]))
                at += 1
            seen += sum(len(texts[i]) for i in own)
            x = np.concatenate(parts)
            first = np.cumsum([0, *map(len, parts[:-1])])
            n = np.diff(np.append(first, len(x)))
            doc = np.repeat(np.arange(len(own)), n)
            a = net.responses(net.tables(), x)
            where = a.argmax(1)
            pooled = np.maximum(np.take_along_axis(a, where[:, None], 1)[:, 0] + net.bias, 0)
            s = net.summary(pooled, first).astype(np.float32)
            h = np.maximum(s @ net.hidden + net.hidden_bias, 0)
            y = 1 / (1 + np.exp(-np.clip(h @ net.out + net.out_bias, -30, 30)))
            dz = ((y - labels[own]) * weight[own] / len(own)).astype(np.float32)
            dh = dz[:, None] * net.out * (h > 0)
            ds = dh @ net.hidden.T
            dpool = ds[doc, :FILTERS] / n[doc, None]
            for k, peak in ((1, s[:, FILTERS : 2 * FILTERS]), (2, s[:, 2 * FILTERS :])):
                hit = pooled == peak[doc]
                dpool = dpool + hit * ds[doc, k * FILTERS : (k + 1) * FILTERS] / np.maximum(1, np.add.reduceat(hit, first))[doc]
            dpool *= pooled > 0
            rows = np.arange(len(x))[:, None]
            byte = x[rows[:, :, None], where[:, :, None] * STRIDE + np.arange(KERNEL)]  # chunks x FILTERS x KERNEL
            dtables = np.zeros((KERNEL, 256, FILTERS), np.float32)
            np.add.at(dtables, (np.arange(KERNEL), byte, np.arange(FILTERS)[None, :, None]), dpool[:, :, None])
            dfilters = np.concatenate([net.embed.T @ d for d in dtables])
            dembed = sum(d @ net.filters[j * EMBED : (j + 1) * EMBED].T for j, d in enumerate(dtables))
            grads = [dembed, dfilters, dpool.sum(0), s.T @ dh, dh.sum(0), h.T @ dz, dz.sum(keepdims=True)]
            t += 1
            rate = 0.004 * max(0.05, 1 - seen / total)
            for q, g, mm, vv in zip(net.params(), grads, m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.01 * (g * g - vv)
                q -= (rate * (mm / (1 - 0.9**t)) / (np.sqrt(vv / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return net


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> tuple[list[bytes], np.ndarray]:
    """Texts and labels of about `most` documents for the driver, by a hash of doc_id, of those that `learn` allows.

    Labels that are null or neither 0 nor 1 aren't used; of a doc_id labelled twice, the greater label; of several
    documents of one doc_id, the one whose text has the least hash, so no repeats reach the driver.
    """
    own = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y")).where(learn)
    n = own.count()
    h = F.pmod(F.shiftright(F.xxhash64(F.lit(9), "doc_id"), 11), F.lit(2**53)) / F.lit(float(2**53))
    chosen = own.where(h < min(1.0, most / max(1, n)))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y")
    rows = found.agg(F.min_by("text", F.xxhash64("text")).alias("text")).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    texts = utf8(rows["text"].combine_chunks())
    return [texts[i] for i in order], rows["y"].to_numpy()[order].astype(np.int64)


def score_quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; score is the probability of label 1.

    The network is fitted on the driver, on about `most` labelled documents at most, of those whose fold is not 1.
    The executors then score every document, in overlapping chunks that cover its whole text.

    Null and empty texts are scored as one chunk of zeros. Without labels of both kinds every score is one number: 0.5
    without any. Rows that repeat get equal scores. Null doc_ids are of fold 0 and never learnt from. An empty
    table gives an empty table; other columns are not read.
    """
    prepare(docs.sparkSession)
    texts, y = sample(docs, labels, "quality", crc_mod(3) != 1, most)
    net = fit(texts, y, epochs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def score(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = net.score(utf8(batch.column(1)))
            return pa.record_batch([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

        return score

    rows = docs.select("doc_id", "text", (crc_mod(3) == 1).alias("held_out"))
    return arrow_map(rows, f"doc_id {kind}, held_out boolean, score double, predicted int", make)
