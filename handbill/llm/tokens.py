"""Token counts, and the cached encoder that packing shares."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import arrow_map, prepare

#: Two white-space characters in a row, or a comma or full stop after anything but a letter or digit: looked for from white space,
#: commas and full stops, to which the search skips.
RUNS = re.compile(r"[\s,.](?:(?<=\s)\s|(?<=[\W_][,.]))")
#: For Arrow's expressions: finds something wherever RUNS does, and where a comma or full stop follows a letter that isn't Latin.
MAYBE_RUNS = "[SPACE][SPACE]|[^0-9A-Za-zÀ-ÖØ-öø-ɏ][,.]".replace("SPACE", r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
#: Safe boundaries: before a single space or line feed between two other characters.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: What opens a part without a space before it.
OPENING = ("\n", ",", ".")
#: Parts with safe boundaries on both sides wherever they stand in a row of such parts.
CHAINED = re.compile(r"[ \n]\S(?:.*\S)?", re.DOTALL)
#: Characters of parts that are encoded as one text.
CHAIN_CHARS = 1 << 16
#: Characters (with 100 for the overhead of each part) whose ids an encoder keeps before it forgets the half used least.
KEPT_CHARS = 110_000_000
#: Where over that share of a group's characters stood in parts not met before, parts don't pay: so many groups after it go to
#: the library as whole texts.
FRESH, DIRECT = 0.4, 5
#: Bytes of text that are encoded together.
GROUP_BYTES = 1 << 23
#: Bytes from which a text is cut by the slow pattern, as Arrow's strings have an end; parts whose ids are joined at once.
HUGE_BYTES, JOINED = 1 << 26, 1 << 18


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """A library's ids of whole texts, as little-endian 32-bit numbers, from ids of parts.

    The byte-level pre-tokenizer never joins what stands on both sides of a safe boundary: the space goes with
    what follows it, the line feed stands alone, and letters or digits end before a comma or full stop. Special
    strings hold none of these, so no boundary falls into one. The library thus encodes each distinct part once, and ids of parts are joined.
    Arrow numbers the distinct parts of a group, so that only those are looked up; ids of all known parts are one array.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a worker for each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.n_bytes = np.zeros(self.library.get_vocab_size(), np.int64)  # of each id: the vocabulary writes a byte as a character
        for token, i in self.library.get_vocab().items():
            self.n_bytes[i] = len(token)
        self.plain: dict[bytes, int] = {}  # the number of a part as it stands
        self.spaced: dict[bytes, int] = {}  # of a part without the space that opens it
        self.start, self.length, self.used = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int32)  # by number: where its ids are, groups with it
        self.ids = np.zeros(1, "<u4")
        self.n_parts = self.n_ids = self.held = self.fresh = self.direct = 0

    def numbers(self, parts: list[bytes], known: dict[bytes, int]) -> np.ndarray:
        """The numbers of distinct parts; new ones are encoded."""
        found = np.fromiter(map(known.get, parts, repeat(-1)), np.int64, len(parts))
        if len(new := np.flatnonzero(found < 0)):
            found[new] = self.learn([parts[i] for i in new.tolist()], known)
        self.used[found] += 1
        return found

    def learn(self, new: list[bytes], known: dict[bytes, int]) -> np.ndarray:
        texts = [x.decode() for x in new]
        chars = sum(map(len, texts))
        self.fresh += chars
        self.held += chars + 100 * len(new)
        if known is self.spaced:
            texts = [x if x[:1] in OPENING else f" {x}" for x in texts]
        chained = np.fromiter((x is not None for x in map(CHAINED.fullmatch, texts)), bool, len(texts))
        number = np.empty(len(new), np.int64)
        for own, together in ((np.flatnonzero(chained), self.together), (np.flatnonzero(~chained), self.apart)):
            parts = [texts[i] for i in own.tolist()]
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))) // CHAIN_CHARS
            edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(parts)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a < b:
                    number[own[a:b]] = self.keep(*together(parts[a:b]))
        known.update(zip(new, number.tolist(), strict=True))
        return number

    def keep(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """New numbers for parts of so many ids each."""
        a, b = self.n_parts, self.n_parts + len(lengths)
        self.start, self.length, self.used = (roomy(x, b) for x in (self.start, self.length, self.used))
        self.ids = roomy(self.ids, self.n_ids + len(ids))
        self.start[a:b], self.length[a:b], self.used[a:b] = self.n_ids + np.cumsum(lengths) - lengths, lengths, 0
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_parts, self.n_ids = b, self.n_ids + len(ids)
        return np.arange(a, b)

    def forget(self) -> None:
        """Keep less than half of the parts, those that most groups had lately."""
        n = self.n_parts
        kept = np.sort(np.argpartition(self.used[:n], n // 2)[n // 2 + 1 :])
        now = np.full(n, -1)
        now[kept] = np.arange(len(kept))
        ids, lengths, used = self.joined(kept), self.length[kept], self.used[kept] // 2
        self.n_parts = self.n_ids = self.held = 0
        self.keep(ids, lengths)
        self.used[: len(kept)] = used
        moved = now.tolist()
        for known in (self.plain, self.spaced):
            left = {x: moved[i] for x, i in known.items() if moved[i] >= 0}
            known.clear()
            known.update(left)
            self.held += sum(map(len, left)) + 100 * len(left)

    def one_by_one(self, parts: list[str]) -> list[bytes]:
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in self.library.encode_batch_fast(parts, add_special_tokens=False)]

    def apart(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = self.one_by_one(parts)
        return np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int64, len(own)) // 4

    def together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts as one text, which is faster; the bytes of ids say where a part ends. Without an end there, one by one."""
        (whole,) = self.library.encode_batch_fast(["".join(parts)], add_special_tokens=False)
        ids = np.asarray(whole.ids, dtype="<u4")
        reached, ends = np.cumsum(self.n_bytes[ids]), np.cumsum([len(x.encode()) for x in parts])
        at = np.searchsorted(reached, ends)
        if at[-1] != len(ids) - 1 or (reached[at] != ends).any():
            return self.apart(parts)
        return ids, np.diff(at, prepend=-1)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these parts in a row."""
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[numbers] - ends + lengths, lengths)]

    def encode(self, texts: list[str], sizes: list[int] | None = None) -> list[bytes]:
        """Ids of each text; texts go together up to GROUP_BYTES by their sizes (their characters where none are given)."""

        def ids(numbers: np.ndarray, ends: np.ndarray) -> list[bytes]:
            raw = b"".join(self.joined(numbers[a : a + JOINED]).tobytes() for a in range(0, len(numbers), JOINED))
            at = (4 * np.cumsum(self.length[numbers])[ends - 1]).tolist()
            return [raw[a:b] for a, b in zip([0, *at], at, strict=False)]

        return self.each(texts, sizes, b"".join, ids)

    def counts(self, texts: list[str], sizes: list[int] | None = None) -> list[int]:
        """How many ids each text has; the ids of whole texts are not put together."""

        def counted(numbers: np.ndarray, ends: np.ndarray) -> list[int]:
            return np.diff(np.cumsum(self.length[numbers])[ends - 1], prepend=0).tolist()

        return self.each(texts, sizes, lambda own: sum(map(len, own)) // 4, counted)

    def each(self, texts: list[str], sizes: list[int] | None, direct: Callable[[list[bytes]], Any], known: Callable[[np.ndarray, np.ndarray], list]) -> list:
        """Something for each text: direct() of its parts' ids, or known() of the numbers of many texts' parts and where each text's end."""
        sizes = list(map(len, texts)) if sizes is None else sizes
        out: list = []
        for group in by_size(list(zip(texts, sizes, strict=True)), size=lambda x: x[1]):
            own = [x for x, _ in group]
            if self.direct:
                self.direct -= 1
                cut = [long_parts(x) for x in own]
                ids = iter(self.one_by_one(list(chain.from_iterable(cut))))
                out += [direct([next(ids) for _ in x]) for x in cut]
                continue
            while self.held > KEPT_CHARS:
                self.forget()
            self.fresh = 0
            found: list = [None] * len(own)
            for rows, numbers, ends in self.group(own):
                for i, x in zip(rows, known(numbers, ends), strict=True):
                    found[i] = x
            out += found
            if self.fresh > FRESH * sum(map(len, own)):
                self.direct = DIRECT
        return out

    def group(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(texts, the numbers of all their parts in order, where each text's end), for texts of both kinds."""
        odd = {i for i, x in enumerate(texts) if len(x) > HUGE_BYTES // 4}
        small = [i for i in range(len(texts)) if i not in odd]
        column = pa.array([texts[i] for i in small], pa.string())
        maybe = pc.match_substring_regex(column, MAYBE_RUNS).to_numpy(zero_copy_only=False)
        odd.update(small[i] for i in np.flatnonzero(maybe).tolist() if RUNS.search(texts[small[i]]))
        if odd:
            cut = {i: CUT.split(texts[i]) for i in sorted(odd)}
            numbers, parts = distinct(pa.array(chain.from_iterable(cut.values()), pa.string()))
            yield list(cut), self.numbers(parts, self.plain)[numbers], np.cumsum([len(x) for x in cut.values()])
            column = column.filter(pa.array([i not in odd for i in small]))
        if len(column):
            for opening in OPENING:
                column = pc.replace_substring(column, opening, f" {opening}")
            words = pc.split_pattern(column, " ")
            ends = np.cumsum(words.value_lengths().to_numpy())
            first = np.concatenate([[0], ends[:-1]])
            numbers, parts = distinct(words.flatten())
            opens, which = np.unique(numbers[first], return_inverse=True)
            later = np.bincount(numbers, minlength=len(parts))
            later[opens] -= np.bincount(which)
            later, known = np.flatnonzero(later), np.zeros(len(parts), np.int64)
            known[later] = self.numbers([parts[i] for i in later.tolist()], self.spaced)
            own = known[numbers]
            own[first] = self.numbers([parts[i] for i in opens.tolist()], self.plain)[which]
            yield [i for i in small if i not in odd], own, ends


def distinct(parts: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Which of the distinct parts each part is, and those as UTF-8."""
    coded = parts.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()).to_pylist()


def roomy(x: np.ndarray, n: int) -> np.ndarray:
    """x, or a copy with room for n items and more."""
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n - len(x), len(x) // 2), x.dtype)])


def long_parts(text: str) -> list[str]:
    """A text in parts of CHAIN_CHARS characters or somewhat more, cut at safe boundaries only."""
    out, a = [], 0
    while len(text) - a > CHAIN_CHARS and (found := CUT.search(text, a + CHAIN_CHARS)):
        out.append(text[a : found.start()])
        a = found.start()
    return [*out, text[a:]]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """A worker process's encoder, which later tasks find filled."""
    return Encoder(path)


def by_size(texts: list, most: int = GROUP_BYTES, size: Callable[..., int] = len) -> list[list]:
    """texts in runs of about the same size: under `most`, or a single text."""
    out: list[list] = []
    held = most
    for x in texts:
        if not out or held + size(x) > most:
            out.append([])
            held = 0
        out[-1].append(x)
        held += size(x)
    return out


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every whole text.

    Counts are the library's for the file at `path`, without added tokens, special strings in texts as
    its default has them, nothing cut or padded. Batches hold about as many bytes each; long texts are
    cut at safe boundaries only. Null texts count as empty: 0 bytes, 0 tokens. Rows that repeat give rows that
    repeat; other columns of docs are not read; an empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    path = path or byte_bpe_path()

    def make():
        encoder = encoder_of(path)

        def counts(batch: pa.RecordBatch) -> pa.RecordBatch:
            lengths = encoder.counts(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            return pa.record_batch([batch.column(0), batch.column(2), pa.array(lengths, pa.int64()), pa.array([x > limit for x in lengths])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

        return counts

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", make, GROUP_BYTES // 2)
