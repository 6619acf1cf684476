"""Near duplicates by the similarity of their shingle sets: candidates from SimHash fingerprints that meet half way, dealt by vantage-point trees, then an exact check."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import acos, ceil, comb, log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from handbill.llm.common import arrow_map, materialise, prepare, utf8
from handbill.llm.graph import components
from handbill.llm.simhash import SAMPLE, Forest, Tree, grouped, keep_least, layout, route

#: Bits of a fingerprint, and how many of them may differ for two sets to meet in its tree.
BITS, WITHIN = 24, 2
#: Numbers of 64 bits, of other fingerprints, that are compared where two sets meet.
BESIDE = 3
#: Probability at most, about, that a pair of the least similarity meets in none of the trees, or is told apart by the numbers beside.
LOSS = 2e-8
#: Least shingles of a set that are looked for in other sets, before it gets fingerprints.
LEAST = 24
#: Sets of fewer shingles than SMALL have VOTES hashes of each shingle in the sum, as so few alone would leave ties.
SMALL, VOTES = 20, 16
#: Sets in a shard of one tree, about, at most.
MOST = 1 << 19
#: Sets of a shard that all are compared with before its fingerprints are.
PEEL = 16
#: Fingerprints that meet half way at once, about; more of them go in parts by their first bits.
MEET = 1 << 17
#: Shingles whose bits are summed at once.
CHUNK = 255
#: Sets that are compared with a bucket before its largest component is chosen.
HUBS = 4
#: Sets of a bucket, and their shingles, that are compared in one task; more of them go in blocks.
CROWD, CROWD_SHINGLES = 4_000, 1 << 22


def odds(n: int, p: float, k: int) -> float:
    """The probability that at most k of n bits differ where each does with probability p."""
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def trees_for(percent: int) -> tuple[int, int]:
    """How many fingerprints sets of this similarity need, and how many of the bits beside may differ.

    Vectors of two sets whose Jaccard similarity is s have a cosine of 2 s / (1 + s) or more, so each bit of a fingerprint differs
    with a probability of acos of that / pi at most, give or take 0.007 for what small sets deviate. Fingerprints are independent: 64
    of them at 0.8, of which a pair then meets in 15. A multiple of 8, as 8 of them are 3 numbers.
    """
    s = percent / 100
    p = acos(2 * s / (1 + s)) / pi + 0.007
    trees = ceil(log(LOSS) / log(1 - odds(BITS, p, WITHIN)) / 8) * 8
    return trees, next(k for k in range(64 * BESIDE + 1) if 1 - odds(64 * BESIDE, p, k) < LOSS / 20)


def shared_least(percent: int) -> int:
    """How many of its LEAST least shingles a set of that many or more has in common with one that it is alike, at least.

    Of the least shingles of both together, those that both have are among the least of either; their number is
    hypergeometric, so below this one with a probability of LOSS / 20 at most.
    """
    s = percent / 100
    return next(k for k in range(LEAST, -1, -1) if k == 0 or 1 - odds(LEAST, 1 - s, LEAST - k) < LOSS / 20)


def classes_of(size: int, percent: int) -> list[int]:
    """The classes of sizes that a set is in: its own, and the next one if a set there could be alike.

    Class k ends before SMALL times its k-th power of two (a higher base for a low percent), so any two sets that are alike have one in common.
    """
    k, end, base = 0, SMALL, max(2, 100 / percent)
    while size >= end:
        k, end = k + 1, end * base
    return [k, k + 1] if 100 * size >= percent * end else [k]


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """The sorted distinct XXH64 of the shingles; a text of fewer words is one shingle, no words: none."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
    return np.unique(np.array([xxh64_intdigest(g, 42) for g in grams], np.uint64))


def fingerprints(held: np.ndarray, trees: int) -> bytes:
    """As many fingerprints of BITS bits, one after another: each bit set if it is in over half of what the shingles hash to for it."""
    step = np.arange(1, trees * BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.zeros(trees * BITS, np.int64)
    for a in range(0, len(held), CHUNK):
        h = held[a : a + CHUNK, None] + step  # finished as in SplitMix64
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        counts += np.unpackbits(h.view(np.uint8), axis=1).sum(0, dtype=np.uint8)
    return np.packbits(2 * counts > len(held)).tobytes()


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """docs' doc_id with text_hash, `fp`, a hash of the shingle set (0 if it has none), how many shingles, and the LEAST least of them."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        from xxhash import xxh64_intdigest

        def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp, size, least = [], [], []
            for text in utf8(batch.column(1)):
                held = shingles(text, words)
                size.append(len(held))
                fp.append(xxh64_intdigest(held.tobytes()) if len(held) else 0)
                least.append(held[:LEAST].view(np.int64))
            fp = np.array(fp, np.uint64).view(np.int64)
            return pa.record_batch([batch.column(0), batch.column(2), pa.array(fp), pa.array(size, pa.int64()), pa.array(least, pa.list_(pa.int64()))], ["doc_id", "text_hash", "fp", "size", "least"])

        return sketch

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return arrow_map(rows, f"doc_id {kind}, text_hash bigint, fp bigint, size bigint, least array<bigint>", make)


def suspects(nodes: DataFrame, percent: int) -> DataFrame:
    """fp, text_hash and size of nodes(fp, text_hash, size, least) that may be alike another: enough of their least shingles are in other sets too.

    Two alike sets of up to LEAST shingles have all that they share among these; of larger ones shared_least() says how many.
    """
    enough, rest = shared_least(percent), nodes.drop("least")
    if not enough:
        return rest
    parts = nodes.select("fp", F.explode("least").alias("shingle"))
    shared = parts.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    found = parts.join(shared, "shingle").groupBy("fp").agg(F.count(F.lit(1)).alias("shared"))
    return rest.join(found, "fp").where(F.col("shared") >= F.least(F.ceil(F.col("size") * percent / 100), F.lit(enough))).drop("shared")


def marks(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """fp of texts(fp, text) with its classes and fingerprints.

    `bits` has the fingerprints of the set, `small` those for the class of small sets; each is null where no class takes it.
    """
    trees, _ = trees_for(percent)

    def make():
        votes = np.arange(VOTES, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)

        def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
            classes, bits, small = [], [], []
            for text in utf8(batch.column(1)):
                held = shingles(text, words)
                own = classes_of(len(held), percent)
                classes.append(own)
                bits.append(fingerprints(held, trees) if own[-1] else None)
                small.append(fingerprints((held[:, None] + votes).ravel(), trees) if not own[0] else None)
            return pa.record_batch([batch.column(0), pa.array(classes, pa.list_(pa.int32())), pa.array(bits, pa.binary()), pa.array(small, pa.binary())], ["fp", "classes", "bits", "small"])

        return mark

    return arrow_map(texts.select("fp", "text"), "fp bigint, classes array<int>, bits binary, small binary", make)


def codes(bits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sets x trees, each fingerprint a number; the same bits as sets x numbers of 64 bits."""
    raw = np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1)
    three = raw.reshape(len(raw), -1, BITS // 8).astype(np.uint32)
    return three[:, :, 0] | three[:, :, 1] << 8 | three[:, :, 2] << 16, raw.view(np.uint64)


def expand(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of ranges of n from each start, one range after another."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def crossed(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All of a range of na from each a with all of the range of nb from its b, some at once."""
    for lo, hi in spans(na):
        left, right, n = expand(a[lo:hi], na[lo:hi]), np.repeat(b[lo:hi], na[lo:hi]), np.repeat(nb[lo:hi], na[lo:hi])
        for i, j in spans(n):
            yield np.repeat(left[i:j], n[i:j]), expand(right[i:j], n[i:j])


def half_way(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each pair of distinct codes within WITHIN (2) once: two such codes are both within 1 of a code, so they meet there.

    Every code goes to BITS + 1 others, which are sorted; work grows with codes times BITS and with the pairs, not with codes compared.
    """
    flips, shift = np.concatenate([[0], 1 << np.arange(BITS)]).astype(np.uint32), BITS - 3
    whole = len(code) <= MEET
    for top in range(1 if whole else 8):
        own = np.arange(len(code)) if whole else np.flatnonzero(np.bitwise_count(code >> shift ^ np.uint32(top)) <= 1)
        key = (code[own] ^ flips[:, None]).astype(np.uint64) << np.uint64(32) | own.astype(np.uint64)
        key = key.ravel() if whole else key[key >> np.uint64(32 + shift) == top]
        key.sort()
        middle, index = (key >> np.uint64(32)).astype(np.uint32), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        at, lag = np.arange(len(key)), 0
        while len(at):  # at most BITS + 1 codes are at one middle
            lag += 1
            at = at[at + lag < len(key)]
            at = at[middle[at + lag] == middle[at]]
            a, b = index[at], index[at + lag]
            once = middle[at] < (code[a] ^ code[b] ^ middle[at])  # the other middle of the pair
            yield a[once], b[once]


def meetings(code: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs (i, j), some at once, whose codes are within WITHIN of each other and whose groups differ."""
    order = np.lexsort((group, code))
    code, group = code[order], group[order]
    fresh_code = np.concatenate([[True], code[1:] != code[:-1]])
    unit = np.flatnonzero(fresh_code | np.concatenate([[True], group[1:] != group[:-1]]))  # sets of one code and group
    n = np.diff(unit, append=len(code))
    first = np.flatnonzero(fresh_code[unit])
    units = np.diff(first, append=len(unit))
    mixed = np.flatnonzero(units > 1)
    for a, b in chain([(mixed, mixed)], half_way(code[unit[first]])):
        for u, v in crossed(first[a], units[a], first[b], units[b]):
            apart = (group[unit[u]] != group[unit[v]]) & ((u < v) | (code[unit[u]] != code[unit[v]]))
            for i, j in crossed(unit[u[apart]], n[u[apart]], unit[v[apart]], n[v[apart]]):
                yield order[i], order[j]


def shard_pairs(shard: pa.Table, apart: int) -> pa.Table:
    """A spanning forest, as (a, b), of the pairs of a shard (fp, code, n0, n1, n2) within the distance that the numbers beside bear out."""
    shard = shard.sort_by("fp")
    fp, code = shard["fp"].to_numpy(), shard["code"].to_numpy().astype(np.uint32)
    beside = np.stack([shard[f"n{k}"].to_numpy() for k in range(BESIDE)], 1).view(np.uint64)
    forest, rng, all_ = Forest(len(fp)), np.random.default_rng(11), np.arange(len(fp))

    def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(beside[a] ^ beside[b]).sum(1, dtype=np.int64) <= apart

    for hub in rng.integers(len(fp), size=PEEL):  # crowds of near copies are one group before they are looked at in pairs
        near = np.flatnonzero(alike(all_, hub))
        forest.add(np.full(len(near), hub), near)
    for a, b in meetings(code, forest.merge().copy()):
        linked = alike(a, b)
        forest.add(a[linked], b[linked])
    root = forest.merge()
    linked = np.flatnonzero(root != all_)
    return pa.table({"a": fp[linked], "b": fp[root[linked]]})


def candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): spanning forests of the pairs of nodes(fp, classes, bits, small) that may be alike.

    Sets of a class are held against each other by each fingerprint. Where a class has over MOST sets, the tops of vantage-point trees, laid out
    on one sample of SAMPLE sets for each shard, deal them to shards: two fingerprints within WITHIN meet half way, as in op1. So they do in a shard.
    """
    trees, apart = trees_for(percent)
    dealt = nodes.select("fp", F.explode("classes").alias("class"), F.when(F.col("class") == 0, F.col("small")).otherwise(F.col("bits")).alias("bits"))
    tops: dict[int, list[Tree]] = {}
    for r in dealt.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect():  # one for each power of two
        if (shards := -(-r["n"] // MOST)) > 1:
            h = F.pmod(F.shiftright(F.xxhash64(F.lit(3), "fp"), 11), F.lit(2**53)) / F.lit(float(2**53))
            chosen = dealt.where((F.col("class") == r["class"]) & (h < min(1.0, shards * SAMPLE / r["n"]))).select("bits").toArrow()["bits"].to_pylist()
            if chosen:
                tops[r["class"]] = [layout(x.astype(np.uint64)) for x in np.sort(codes(sorted(chosen))[0].T)]

    def make():
        def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            code, numbers = codes(batch.column(2).to_pylist())
            out = []
            for k in np.unique(own).tolist():
                rows = np.flatnonzero(own == k)
                for t in range(trees):
                    index, leaf = np.arange(len(rows)), np.zeros(len(rows), np.int64)
                    if k in tops:
                        index, leaf, point = route(code[rows, t].astype(np.uint64), tops[k][t], WITHIN)
                        assert point.all()  # of an even distance either half is the same
                    at, last = rows[index], (BITS // 8 * t + BITS // 8 - 1) // 8
                    beside = (last + 1 + np.arange(BESIDE)) % numbers.shape[1]
                    out.append((leaf * (trees * 64) + k * trees + t, fp[at], code[at, t].astype(np.int32), *numbers[at][:, beside].view(np.int64).T))
            return pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["shard", "fp", "code", "n0", "n1", "n2"])

        return deal

    points = arrow_map(dealt, "shard bigint, fp bigint, code int, n0 bigint, n1 bigint, n2 bigint", make)
    return points.groupBy("shard").applyInArrow(lambda shard: shard_pairs(shard, apart), "a bigint, b bigint")


def sets(texts: DataFrame, words: int) -> DataFrame:
    """fp and `held`, the shingle set as bytes, of texts(fp, text)."""

    def make():
        def batch_sets(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([batch.column(0), pa.array([shingles(x, words).tobytes() for x in utf8(batch.column(1))], pa.binary())], ["fp", "held"])

        return batch_sets

    return arrow_map(texts.select("fp", "text"), "fp bigint, held binary", make)


def bucket_links(fp: np.ndarray, held: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of sets whose Jaccard similarity is percent / 100 or more.

    A set shares percent / 100 of its shingles with any that it is alike, so two such sets share one of their rarest few, as
    many as the rest of either and one more. Only these are looked up; sets of near sizes that have one in common are candidates, whose
    overlap is counted. A set in the component that grows from one of the first HUBS is not asked again: its links to others are
    found when those are asked.
    """
    m, size = len(held), np.array([len(x) for x in held])
    _, token, df = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    rarity = np.empty(len(df), np.int64)
    rarity[np.argsort(df, kind="stable")] = np.arange(len(df))
    of = np.repeat(np.arange(m), size)
    order = np.lexsort((rarity[token], of))
    token = token[order]  # each set's shingles, rarest first
    start = np.concatenate([[0], np.cumsum(size)])
    few = size - -(-percent * size // 100) + 1
    leads = (np.arange(len(token)) - start[of] < few[of]) & (df[token] > 1)
    lead, owner = token[leads], of[leads]
    own_lead = np.searchsorted(owner, np.arange(m + 1))
    by_token = np.argsort(lead, kind="stable")
    posting, keys = owner[by_token], lead[by_token]
    forest, root, hub, inside = Forest(m), np.arange(m), -1, np.zeros(len(df), bool)
    asked = np.flatnonzero(np.diff(own_lead) > 0)
    for k, i in enumerate(asked):
        if k == HUBS:
            hub = asked[np.argmax(np.bincount(root, minlength=m)[root[asked[:HUBS]]])]
        if hub >= 0 and root[i] == root[hub]:
            continue
        mine = lead[own_lead[i] : own_lead[i + 1]]
        lo, hi = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
        n = hi - lo
        near = np.unique(posting[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())])
        near = near[(root[near] != root[i]) & (100 * size[near] >= percent * size[i]) & (100 * size[i] >= percent * size[near])]
        if not len(near):
            continue
        inside[token[start[i] : start[i + 1]]] = True
        alike = []
        for a, b in spans(size[near]):
            some = near[a:b]
            at = np.repeat(start[some] - np.cumsum(size[some]) + size[some], size[some]) + np.arange(size[some].sum())
            overlap = np.add.reduceat(inside[token[at]], np.cumsum(size[some]) - size[some], dtype=np.int64)
            alike.append(some[(100 + percent) * overlap >= percent * (size[some] + size[i])])
        inside[token[start[i] : start[i + 1]]] = False
        alike = np.concatenate(alike)
        if len(alike):
            forest.add(np.full(len(alike), i), alike)
            root = forest.merge()
    linked = np.flatnonzero(root != np.arange(m))
    return fp[linked], fp[root[linked]]


def spans(size: np.ndarray, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of sets of about `most` shingles together."""
    cut = np.flatnonzero(np.diff(np.cumsum(size) // most)) + 1
    edges = [0, *cut.tolist(), len(size)]
    return list(zip(edges, edges[1:], strict=False))


def table_links(*tables: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets (fp, held) of all tables, each once, and for each the least of those that links join it to."""
    both = pa.concat_tables([t.select(["fp", "held"]) for t in tables])
    fp, first = np.unique(both["fp"].to_numpy(), return_index=True)
    held = [np.frombuffer(x, np.uint64) for x in both["held"].take(pa.array(first)).to_pylist()]
    a, b = bucket_links(fp, held, percent) if len(fp) > 1 else (fp[:0], fp[:0])
    root = fp.copy()
    root[np.searchsorted(fp, a)] = b
    return fp, root


def main_hubs(seen: list[tuple[int, int]]) -> int:
    """Of (hubs as bits, sets joined to them) the hubs, joined by sets that several reach, that have most sets."""
    groups: dict[int, int] = {}
    for mask, n in seen:
        if mask:
            alike = [g for g in groups if g & mask]
            groups[mask | sum_bits(alike)] = n + sum(groups.pop(g) for g in alike)
    return max(groups, key=lambda g: (groups[g], g), default=0)


def sum_bits(masks: list[int]) -> int:
    out = 0
    for m in masks:
        out |= m
    return out


def crowd_links(crowd: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of crowd(bucket, n, total, fp, held), buckets of n sets and so many shingles, of which no task holds more than some blocks.

    A bucket's sets are dealt to blocks of about CROWD, or CROWD_SHINGLES shingles, each compared within itself and with a few hubs of the bucket. Nearly
    all sets of a crowd of near copies are so joined to one component of hubs. Sets that aren't are compared with every
    block, in blocks of their own. Two sets joined to that component need no look at each other; so no link between
    components is lost, and work grows with the crowd times its sets outside the component.
    """
    def parts(sets_: Column, shingles_: Column) -> Column:
        return F.ceil(F.greatest(sets_ / CROWD, shingles_ / CROWD_SHINGLES)).cast("int")

    blocks = parts(F.col("n"), F.col("total"))
    crowd = materialise(crowd.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "fp"), blocks).cast("int")), "crowd")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64(F.lit(5), "fp"), "fp"))
    hubs = crowd.select("bucket", "n", "total", "fp", rank.alias("rank")).where(F.col("rank") <= HUBS)
    hubs = hubs.join(crowd.select("bucket", "fp", "held"), ["bucket", "fp"]).withColumn("block", every)
    hubs = hubs.toDF(*hubs.columns)  # columns of its own, as crowd is on both sides below

    def within(own: pa.Table, hub: pa.Table) -> pa.Table:
        fp, root = table_links(own, hub, percent=percent)
        at = root[np.searchsorted(fp, hub["fp"].to_numpy())]
        mask = np.zeros(len(fp), np.int32)
        for bit, r in zip((hub["rank"].to_numpy() - 1).tolist(), at.tolist(), strict=True):
            mask[root == r] |= np.int32(1 << bit)
        member = np.isin(fp, own["fp"].to_numpy())
        return pa.table({"bucket": pa.array([hub["bucket"][0].as_py()] * len(fp), pa.int64()), "fp": fp, "root": root, "mask": mask, "member": member})

    key = ["bucket", "block"]
    joined = materialise(crowd.groupBy(*key).cogroup(hubs.groupBy(*key)).applyInArrow(within, "bucket bigint, fp bigint, root bigint, mask int, member boolean"), "joined")
    seen = joined.where("member").groupBy("bucket", "mask").agg(F.count(F.lit(1)).alias("sets"))
    chosen = seen.groupBy("bucket").agg(F.collect_list(F.struct("mask", "sets")).alias("seen"))  # at most 2 ** HUBS

    def main_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_hubs([(x["mask"], x["sets"]) for x in own]) for own in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(found, pa.int32())], ["bucket", "main"])

    main = arrow_map(chosen, "bucket bigint, main int", lambda: main_of)
    out = joined.where("member").join(main, "bucket").where(F.col("mask").bitwiseAND(F.col("main")) == 0).select("bucket", "fp")
    sized = out.join(crowd.select("bucket", "fp", (F.octet_length("held") / 8).alias("size")), ["bucket", "fp"])
    counts = sized.groupBy("bucket").agg(parts(F.count(F.lit(1)), F.sum("size")).alias("parts"))
    outside = out.join(counts, "bucket").withColumn("part", F.pmod(F.xxhash64(F.lit(3), "fp"), F.col("parts")).cast("int"))
    outside = outside.join(crowd.select("bucket", "n", "total", "fp", "held"), ["bucket", "fp"]).withColumn("block", every)
    outside = outside.toDF(*outside.columns)
    others = crowd.join(counts, "bucket").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def across(own: pa.Table, rest: pa.Table) -> pa.Table:
        fp, root = table_links(own, rest, percent=percent)
        return pa.table({"a": fp[fp != root], "b": root[fp != root]})

    key = ["bucket", "block", "part"]
    more = outside.groupBy(*key).cogroup(others.groupBy(*key)).applyInArrow(across, "a bigint, b bigint")
    return joined.where("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b")).unionByName(more)


def links(docs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): spanning forests of the pairs that are alike.

    Only suspects get fingerprints. What candidates link is a bucket, in which sets are compared exactly. They are made only for texts
    in a bucket, one for each. Buckets of over CROWD sets or CROWD_SHINGLES shingles go in blocks.
    """
    own = rows.where("size > 0").groupBy("fp").agg(F.min("text_hash").alias("text_hash"), F.first("size").alias("size"), F.first("least").alias("least"))
    wanted = suspects(materialise(own, "nodes"), percent)
    texts = docs.select("text", F.xxhash64("text").alias("text_hash")).join(wanted, "text_hash").dropDuplicates(["fp"])
    texts = materialise(texts.select("fp", "size", "text"), "texts")
    found = components(candidates(materialise(marks(texts, words, percent), "marks"), percent))
    roots = found.select(F.col("root").alias("fp"), F.col("root").alias("bucket")).distinct()
    members = found.select(F.col("node").alias("fp"), F.col("root").alias("bucket")).unionByName(roots).join(texts.select("fp", "size"), "fp")
    summed = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))
    chosen = materialise(members.drop("size").join(summed, "bucket"), "buckets")

    def verify(bucket: pa.Table) -> pa.Table:
        fp, root = table_links(bucket, percent=percent)
        return pa.table({"a": fp[fp != root], "b": root[fp != root]})

    whole = chosen.join(sets(texts.join(chosen.select("fp"), "fp"), words), "fp")
    many = (F.col("n") > CROWD) | (F.col("total") > CROWD_SHINGLES)
    crowded = not chosen.where(many).isEmpty()
    whole = materialise(whole, "whole") if crowded else whole
    close = whole.where(~many).groupBy("bucket").applyInArrow(verify, "a bigint, b bigint")
    if not crowded:
        return close
    return close.unionByName(crowd_links(whole.where(many), percent))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, fp, component_id for every document; component_id is the smallest doc_id reachable by links.

    Documents are linked if the Jaccard similarity of their sets of shingles of that many words is percent / 100 or
    more (a pair is missed with a probability of about LOSS at most). Equal sets are one node; texts without words (null, empty, blank) are one too, and are linked to no other; a
    text of fewer words than a shingle is one shingle. Null doc_ids count for component_id only if a component has
    no other, which is then null. Rows that repeat give rows that repeat. An empty table gives an empty table; other
    columns are not read.
    """
    rows = materialise(sketches(docs, words), "sketches")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return grouped(rows.drop("size", "least"), nodes, links(docs, rows, words, percent))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id (null before all), whole.

    Rows that repeat in doc_id and text count as one. Null, empty and blank texts are one group. An empty table gives
    an empty table; other columns pass through, whatever their names.
    """
    return keep_least(docs, near_duplicates(docs, **options))
