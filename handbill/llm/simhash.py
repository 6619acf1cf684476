"""SimHash near-duplicates, found by vantage-point trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import arrow_map, fresh, materialise, prepare, utf8
from handbill.llm.graph import components

#: Fingerprints for each shard, about, from which the driver lays out the top of the tree (300 bytes a shard).
SAMPLE = 32
#: Fingerprints in a shard, about: LEAST while those make few tasks (up to TASKS), at most MOST.
LEAST, MOST, TASKS = 2_000, 262_144, 64
#: Points and queries that are compared at once, and links that are merged at once.
CELLS, LINKS = 1 << 21, 1 << 20


def simhash(text: bytes, words: int = 3) -> int:
    """The 64 bits, each set if it is in over half of the shingles' XXH64; no words: zero."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()
    if not w:
        return 0
    counts, n = np.zeros(64, np.int64), max(1, len(w) - words + 1)
    for a in range(0, n, 1 << 16):
        part = w[a : a + (1 << 16) + words - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
        h = np.array([xxh64_intdigest(g, 42) for g in grams], ">u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) // 255 * 255
        counts += bits[whole:].sum(0, dtype=np.int64) + bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """docs' doc_id with `fp`, the fingerprint as a signed number, and `text_hash`. Null texts have no words."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def batch_fp(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp = [simhash(x, words) for x in utf8(batch.column(1))]
            return pa.record_batch([batch.column(0), batch.column(2), pa.array(fp, pa.int64())], ["doc_id", "text_hash", "fp"])

        return batch_fp

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return arrow_map(rows, f"doc_id {kind}, text_hash bigint, fp bigint", make)


def far(x: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ point)


@dataclass
class Tree:
    """The top of a vantage-point tree: of each node its point, its radius and its children inside and outside.

    A child below zero is a leaf: leaf k is -1 - k.
    """

    points: np.ndarray
    radii: np.ndarray
    children: np.ndarray  # nodes x 2
    leaves: int


def layout(sample: np.ndarray, most: int = SAMPLE, seed: int = 7) -> Tree:
    """Splits the sample until each part holds at most `most`, however deep that goes where fingerprints crowd.

    Of a few candidates the vantage point is the one from which distances differ most; its radius is their median.
    """
    rng = np.random.default_rng(seed)
    points, radii, children, leaves = [], [], [], 0
    todo = [(sample, -1, 0)]
    while todo:
        own, parent, side = todo.pop()
        split = None
        if len(own) > most:
            d = far(own[None, :], own[rng.integers(len(own), size=8)][:, None]).astype(np.int64)
            best = int(d.std(axis=1).argmax())
            r = int(np.median(d[best]))
            r -= int((d[best] <= r).all())  # a median that is the greatest distance would leave the outside empty
            if (d[best] <= r).any():
                split = (own[np.flatnonzero(d[best] == 0)[0]], r, d[best] <= r)
        number = len(points) if split else -1 - leaves
        if parent >= 0:
            children[parent][side] = number
        if not split:
            leaves += 1
            continue
        points.append(split[0])
        radii.append(split[1])
        children.append([0, 0])
        todo += [(own[~split[2]], number, 1), (own[split[2]], number, 0)]
    return Tree(np.array(points, np.uint64), np.array(radii, np.int64), np.array(children, np.int64).reshape(-1, 2), leaves)


def route(fp: np.ndarray, tree: Tree, within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fp, leaf, whether it is a point there) of each leaf that a ball around a fingerprint can reach.

    Two fingerprints of a distance of at most `within` have one between them, half way, that falls into a single leaf. So
    it is enough that each is a point in all leaves within half that distance of it, rounded down, and is asked in all
    within half of it, rounded up: rows grow by 1.4 a level instead of the 1.55 of a single home asked in a whole ball.
    """
    short, wide = within // 2, within - within // 2
    index, node, point = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
    if not len(tree.points):
        return index, node, point
    done = []
    while len(index):
        d = far(fp[index], tree.points[node]).astype(np.int64) - tree.radii[node]
        inside, outside = d <= wide, d > -wide
        index, node, point = (
            np.concatenate([index[inside], index[outside]]),
            np.concatenate([tree.children[node[inside], 0], tree.children[node[outside], 1]]),
            np.concatenate([point[inside] & (d[inside] <= short), point[outside] & (d[outside] > -short)]),
        )
        ends = node < 0
        done.append((index[ends], -1 - node[ends], point[ends]))
        index, node, point = index[~ends], node[~ends], point[~ends]
    return tuple(np.concatenate(x) for x in zip(*done, strict=True))


class Forest:
    """Union-find over 0..n-1 that takes links in bulk."""

    def __init__(self, n: int):
        self.parent, self.held, self.n = np.arange(n), [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.held.append((a, b))
            self.n += len(a)
            if self.n > LINKS:
                self.merge()

    def merge(self) -> np.ndarray:
        p = self.parent
        if self.held:
            a, b = (np.concatenate(x) for x in zip(*self.held, strict=True))
            self.held, self.n = [], 0
            while len(a):
                ra, rb = p[a], p[b]
                apart = ra != rb
                a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
                np.minimum.at(p, np.maximum(ra, rb), np.minimum(ra, rb))
                while (q := p[p]).tobytes() != p.tobytes():
                    p = q
            self.parent = p
        return p


def search(fp: np.ndarray, points: np.ndarray, queries: np.ndarray, within: int, forest: Forest, rng: np.random.Generator, leaf: int = 192) -> None:
    """Link every query to every point within the distance: a vantage-point tree, built as the queries go down it.

    points and queries index fp. A branch is left out if the triangle bound shows that no query
    can reach it.
    """
    todo = [(points, queries)]
    while todo:
        points, queries = todo.pop()
        if not len(points) or not len(queries):
            continue
        if len(points) > leaf and len(queries) > 1:
            vantage = fp[points[rng.integers(len(points))]]
            d = far(fp[points], vantage)
            r = int(np.median(d))
            inside = d <= r
            if 0 < inside.sum() < len(points):
                dq = far(fp[queries], vantage).astype(np.int64)
                todo += [(points[inside], queries[dq <= r + within]), (points[~inside], queries[dq > r - within])]
                continue
        step = max(1, CELLS // len(points))
        for a in range(0, len(queries), step):
            q = queries[a : a + step]
            i, j = np.nonzero(np.bitwise_count(fp[q][:, None] ^ fp[points][None, :]) <= within)
            different = q[i] != points[j]
            forest.add(q[i][different], points[j][different])


def shard_links(group: pd.DataFrame, within: int) -> pd.DataFrame:
    """A spanning forest, as (a, b), of the links between a shard's points and its queries: at most a row a query."""
    fp, where = np.unique(group["fp"].to_numpy().view(np.uint64), return_inverse=True)
    forest = Forest(len(fp))
    search(fp, np.unique(where[group["point"].to_numpy()]), np.unique(where), within, forest, np.random.default_rng(11))
    root = forest.merge()
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return pd.DataFrame({"a": fp[linked].view(np.int64), "b": fp[root[linked]].view(np.int64)})


def links(distinct: DataFrame, n: int, within: int = 3, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(a, b): spanning forests that link all pairs of distinct(fp), of which there are n, within the distance.

    The top of a vantage-point tree, laid out on a sample of SAMPLE for each shard, deals fingerprints to shards; every pair
    within the distance meets in one of them. Where fingerprints crowd the tree is deeper, so shards are about
    as large as each other: at most about `most`, or `least` while that makes few of them. Each shard has a tree of its own.
    """
    shards = max(-(-n // most), min(TASKS, -(-n // least)), 1)
    h = F.pmod(F.shiftright(F.xxhash64(F.lit(3), "fp"), 11), F.lit(2**53)) / F.lit(float(2**53))
    chosen = distinct.where(h < min(1.0, shards * SAMPLE / max(1, n))).select("fp").toArrow()["fp"].to_numpy()
    tree = layout(np.sort(chosen).view(np.uint64))

    def make():
        def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp = batch.column(0).to_numpy()
            index, leaf, point = route(fp.view(np.uint64), tree, within)
            return pa.record_batch([pa.array(leaf.astype(np.int32)), pa.array(fp[index]), pa.array(point)], ["leaf", "fp", "point"])

        return deal

    dealt = arrow_map(distinct.select("fp"), "leaf int, fp bigint, point boolean", make)
    return dealt.groupBy("leaf").applyInPandas(lambda group: shard_links(group, within), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 3, within: int = 3) -> DataFrame:
    """doc_id, text_hash, fp, component_id for every document; component_id is the smallest doc_id reachable by links.

    Documents are linked if their fingerprints differ in at most `within` bits. Equal fingerprints are one
    node; links between nodes come as spanning forests, so no group is expanded into its pairs. Null,
    empty and blank texts have fingerprint zero and are linked like any other; so are texts of fewer words than
    a shingle. Null doc_ids count for component_id only if a component has no other, which is then null.
    Rows that repeat give rows that repeat. An empty table gives an empty table; other columns are not read.
    """
    rows = materialise(fingerprints(docs, words), "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    return grouped(rows, nodes, links(nodes, nodes.count(), within))


def grouped(rows: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """rows with component_id: the smallest of nodes(fp, least) in the component that edges(a, b) make."""
    roots = components(edges).withColumnRenamed("node", "fp")
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    found = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(nodes.join(found, "root").select("fp", "component_id"), "fp")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id (null before all), whole.

    Rows that repeat in doc_id and text count as one, of which any stays. Null, empty and blank texts are near duplicates
    of each other. An empty table gives an empty table; other columns pass through, whatever their names.
    """
    return keep_least(docs, near_duplicates(docs, **options))


def keep_least(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of each component of found, which near_duplicates() returns."""
    least = F.min(F.struct("doc_id", "text_hash"))
    with_root = found.withColumn("group", F.when(F.col("component_id").isNull(), F.struct(F.col("fp").alias("k"), F.lit(0).alias("z"))).otherwise(F.struct(F.col("component_id").alias("k"), F.lit(1).alias("z"))))
    keep = with_root.groupBy("group").agg(least.alias("kept")).select("kept.*")
    ours, theirs, hashed = fresh(docs, "own_hash"), fresh(docs, "kept_id"), fresh(docs, "kept_hash")
    keep = keep.select(F.col("doc_id").alias(theirs), F.col("text_hash").alias(hashed))
    kept = docs.withColumn(ours, F.xxhash64("text")).join(keep, F.col("doc_id").eqNullSafe(F.col(theirs)) & (F.col(ours) == F.col(hashed)))
    return kept.dropDuplicates([theirs, hashed]).select(*docs.columns)
