"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from handbill.llm.common import materialise, prepare

#: Vectors in a shard: at least about LEAST, so that few of them still make many tasks (up to TASKS); at most about MOST
#: and SHARD_BYTES.
LEAST, MOST, TASKS, SHARD_BYTES = 4_096, 65_536, 64, 1 << 26
#: Queries that meet an index in one task, as large as an index, and those that go through the graph together.
BLOCK, TOGETHER = 32_768, 256
#: Links of a node above the ground layer (twice as many on it), candidates for them, and the beam of a search in a shard of
#: LEAST; it grows with the root of the shard.
LINKS, CANDIDATES, BEAM = 16, 64, 128
#: Nodes that are inserted together.
BATCH = 512
#: Powers of two that a class of sizes spans: squares of the smallest differences in it are still normal numbers.
CLASS = 400
#: Components whose squares neither overflow nor vanish in double precision lie between these.
SMALL, LARGE = 1e-140, 1e140


def usable(embedding: str) -> Column:
    """Neither null nor empty nor zero, and no component null or non-finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(embedding).isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def squares(x: np.ndarray, axis: str = "abc,abc->ab") -> np.ndarray:
    return np.einsum(axis, x, x)


def size_class(v: str) -> Column:
    """Which CLASS powers of two the largest component lies in. Vectors of one class are indexed together.

    Beside a much larger vector the squares of all others would vanish.
    """
    return F.floor((F.log2(F.array_max(F.transform(v, F.abs))) + CLASS / 2) / CLASS).cast("int")


def exponent(vectors: np.ndarray) -> int:
    """The power of two by which vectors of one class are divided, so that squares neither overflow nor vanish: none for ordinary ones."""
    top = int(np.frexp(np.abs(vectors).max(initial=0))[1])
    return 0 if abs(top) <= CLASS // 2 else top


def scaled(x: np.ndarray, by: int) -> np.ndarray:
    """Rows divided by 2 ** by, and further where a row is still beyond a class.

    Such a row is a query so large that all distances of the class are its own length, in double precision.
    """
    if by:
        x = np.ldexp(x, -by)
    top = np.frexp(np.abs(x).max(1, initial=0))[1]
    return x if top.max(initial=0) <= CLASS else np.ldexp(x, -np.maximum(top - CLASS, 0)[:, None])


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows in double precision; of extreme ones by way of their largest component."""
    with np.errstate(over="ignore", under="ignore"):
        d = a - b
        out = np.sqrt(squares(d, "ab,ab->a"))
        odd = np.flatnonzero(~(out < LARGE) | (out < SMALL))
        if len(odd):
            most = np.abs(d[odd]).max(1)
            part = d[odd] / np.where(most > 0, most, 1)[:, None]
            out[odd] = most * np.sqrt(squares(part, "ab,ab->a"))
    return out


def diverse(x: np.ndarray, vectors: np.ndarray, near: np.ndarray, d: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first (-1: none), up to `most`: those nearer to it than to any chosen before, then others.

    Distances between candidates come from their differences to the row, so nothing is lost however far all are from zero.
    """
    out = np.full((len(near), most), -1, np.int64)
    for a in range(0, len(near), 512):
        own, dist = near[a : a + 512], d[a : a + 512]
        there = own >= 0
        apart = np.where(there[:, :, None], vectors[np.maximum(own, 0)] - x[a : a + 512, None, :], 0)
        between = -2 * (apart @ apart.transpose(0, 2, 1))
        own_square = squares(apart)
        between += own_square[:, :, None]
        between += own_square[:, None, :]
        taken, n = np.zeros(own.shape, bool), np.zeros(len(own), np.int64)
        for k in range(own.shape[1]):
            beside = np.where(taken, between[:, k], np.inf).min(1)
            taken[:, k] = there[:, k] & (n < most) & (dist[:, k] <= beside)
            n += taken[:, k]
        order = np.argsort(np.where(taken, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :most]
        picked = np.take_along_axis(own, order, 1)
        out[a : a + 512, : picked.shape[1]] = picked
    return out


class Layer:
    """One layer of the graph: its nodes' numbers, their vectors, and a flat neighbour array in places, -1 where there is none."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray, links: np.ndarray):
        self.nodes, self.links = nodes, links
        self.vectors = vectors if len(nodes) == len(vectors) else vectors[nodes]

    def gap(self, q: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its places, in runs that stay in a processor's cache."""
        row, column = np.nonzero(places >= 0)
        at, out, d = places[row, column], np.full(places.shape, np.inf), np.empty(len(row))
        for a in range(0, len(row), 2048):
            x = self.vectors.take(at[a : a + 2048], axis=0)
            x -= q.take(row[a : a + 2048], axis=0)
            d[a : a + 2048] = squares(x, "ab,ab->a")
        out[row, column] = d
        return out

    def descend(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """From the places `at`, as near to each query as single steps lead."""
        at, moving = at.copy(), np.arange(len(q))
        best = self.gap(q, at[:, None])[:, 0]
        while len(moving):
            around = self.links[at[moving]]
            d = self.gap(q[moving], around)
            step = d.argmin(1)
            rows = np.arange(len(moving))
            better = d[rows, step] < best[moving]
            rows, step, moving = rows[better], step[better], moving[better]
            at[moving], best[moving] = around[rows, step], d[rows, step]
        return at

    def search(self, q: np.ndarray, at: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` places found nearest to each query (-1: fewer), nearest first, and their squared distances."""
        m, everyone = len(q), np.arange(len(q))
        seen = np.zeros((m, len(self.nodes)), bool)
        seen[everyone, at] = True
        found, far, open_ = np.full((m, beam), -1, np.int64), np.full((m, beam), np.inf), np.zeros((m, beam), bool)
        found[:, 0], far[:, 0], open_[:, 0] = at, self.gap(q, at[:, None])[:, 0], True
        active = everyone
        while len(active):
            first = np.argsort(np.where(open_[active], far[active], np.inf), axis=1, kind="stable")[:, :wide]
            fit = np.take_along_axis(open_[active], first, 1)
            go = fit.any(1)
            active, first, fit = active[go], first[go], fit[go]
            if not len(active):
                break
            nodes = np.where(fit, np.take_along_axis(found[active], first, 1), -1)
            open_[active[:, None], first] = False
            around = np.where((nodes >= 0)[:, :, None], self.links[np.maximum(nodes, 0)], -1).reshape(len(active), -1)
            around = np.sort(around, axis=1)
            again = np.concatenate([np.zeros((len(active), 1), bool), around[:, 1:] == around[:, :-1]], axis=1)
            around = np.where(again | seen[active[:, None], np.maximum(around, 0)], -1, around)
            around = -np.sort(-around, axis=1)[:, : max(1, int((around >= 0).sum(1).max()))]
            r, c = np.nonzero(around >= 0)
            seen[active[r], around[r, c]] = True
            d = np.concatenate([far[active], self.gap(q[active], around)], axis=1)
            ids = np.concatenate([found[active], around], axis=1)
            flags = np.concatenate([open_[active], around >= 0], axis=1)
            best = np.argpartition(d, beam - 1, axis=1)[:, :beam]
            found[active], far[active], open_[active] = (np.take_along_axis(x, best, 1) for x in (ids, d, flags))
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(found, order, 1), np.take_along_axis(far, order, 1)

    def insert(self, lo: int, hi: int, found: np.ndarray | None, far: np.ndarray | None) -> None:
        """Link the places [lo, hi) to diverse ones of those found before them and of each other, and these back to them."""
        x, most = self.vectors[lo:hi], self.links.shape[1]
        peers = np.concatenate([squares(x[a : a + 32, None, :] - x[None, :, :]) for a in range(0, len(x), 32)])
        np.fill_diagonal(peers, np.inf)
        near, d = np.broadcast_to(np.arange(lo, hi), peers.shape), peers
        if found is not None:
            near, d = np.concatenate([found, near], axis=1), np.concatenate([far, d], axis=1)
        if d.shape[1] > CANDIDATES:
            best = np.argpartition(d, CANDIDATES - 1, axis=1)[:, :CANDIDATES]
            near, d = np.take_along_axis(near, best, 1), np.take_along_axis(d, best, 1)
        order = np.argsort(d, axis=1, kind="stable")
        near, d = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
        forward = diverse(x, self.vectors, np.where(np.isinf(d), -1, near), d, most // 2)
        self.links[lo:hi, : most // 2] = forward
        # back: each target's links and new ones together, diverse ones of them where there are too many
        r, k = np.nonzero(forward >= 0)
        target, source = forward[r, k], r + lo
        known = (self.links[target] == source[:, None]).any(1)
        target, source = target[~known], source[~known]
        gap = squares(self.vectors[target] - self.vectors[source], "ab,ab->a")
        order = np.lexsort((gap, target))
        target, source = target[order], source[order]
        whom, first = np.unique(target, return_index=True)
        place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        fits = place < most
        new = np.full((len(whom), most), -1, np.int64)
        new[np.searchsorted(whom, target[fits]), place[fits]] = source[fits]
        for a in range(0, len(whom), 2048):
            own = whom[a : a + 2048]
            both = np.concatenate([self.links[own], new[a : a + 2048]], axis=1).astype(np.int64)
            d = self.gap(self.vectors[own], both)
            order = np.argsort(d, axis=1, kind="stable")
            both, d = np.take_along_axis(both, order, 1), np.take_along_axis(d, order, 1)
            crowded = (both >= 0).sum(1) > most
            self.links[own] = both[:, :most]
            if crowded.any():
                width = int((both[crowded] >= 0).sum(1).max())
                self.links[own[crowded]] = diverse(self.vectors[own[crowded]], self.vectors, both[crowded, :width], d[crowded, :width], most)


def build(vectors: np.ndarray, seed: int = 5) -> list[Layer]:
    """Layers from the ground up. Nodes are inserted in their order, a batch at a time.

    A batch goes down the graph that stands: by single steps through layers that its nodes don't join, by a beam search
    for candidates through those that they do. Nodes of one batch are candidates of each other by their distances.
    """
    n = len(vectors)
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
    layers = []
    for k in range(int(level.max(initial=0)) + 1):
        nodes = np.flatnonzero(level >= k)
        layers.append(Layer(vectors, nodes, np.full((len(nodes), LINKS * (2 if k == 0 else 1)), -1, np.int32)))
    a = 0
    while a < n:
        b = min(n, a + min(BATCH, max(32, a)))
        q, at, above = vectors[a:b], None, None
        for layer in layers[::-1]:
            lo, hi = np.searchsorted(layer.nodes, [a, b])
            joins = layer.nodes[lo:hi] - a
            found = far = None
            if lo:
                at = np.zeros(b - a, np.int64) if at is None else np.searchsorted(layer.nodes, above.nodes[at])
                passes = np.ones(b - a, bool)
                passes[joins] = False
                at[passes] = layer.descend(q[passes], at[passes])
                for s in range(0, len(joins), TOGETHER):
                    own = joins[s : s + TOGETHER]
                    x, y = layer.search(q[own], at[own], CANDIDATES)
                    at[own] = x[:, 0]
                    found, far = (x, y) if found is None else (np.concatenate([found, x]), np.concatenate([far, y]))
                above = layer
            if hi > lo:
                layer.insert(lo, hi, found, far)
        a = b
    return layers


def search(layers: list[Layer], queries: np.ndarray, k: int, beam: int = BEAM) -> np.ndarray:
    """For each query the k nodes found nearest (-1: there are fewer). One that met fewer is answered from all nodes."""
    out, ground = [], layers[0]
    k = min(k, len(ground.nodes))
    beam = max(k, int(beam * max(1.0, len(ground.nodes) / LEAST) ** 0.5))
    for a in range(0, len(queries), TOGETHER):
        q = queries[a : a + TOGETHER]
        at, above = np.zeros(len(q), np.int64), layers[-1]
        for layer in layers[:0:-1]:
            at, above = layer.descend(q, np.searchsorted(layer.nodes, above.nodes[at])), layer
        found = ground.search(q, np.searchsorted(ground.nodes, above.nodes[at]), beam)[0][:, :k]
        for i in np.flatnonzero((found < 0).any(1)):
            found[i] = np.argsort(squares(ground.vectors - q[i], "ab,ab->a"), kind="stable")[:k]
        out.append(found)
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


INDEX = "shard int, dim int, ids binary, rows binary, vectors binary, nodes array<binary>, links array<binary>"


def index_shard(rows: pa.Table) -> pa.Table:
    """One row: equal vectors are one node; ids has all their vec_ids in order, rows where each node's begin."""
    ids = rows["vec_id"].to_numpy()
    dim = rows["dim"][0].as_py()
    vectors = rows["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
    unique, node = np.unique(vectors, axis=0, return_inverse=True)
    shuffled = np.random.default_rng(3).permutation(len(unique))
    node = np.argsort(shuffled)[node.ravel()]
    vectors = unique[shuffled]
    pairs = np.unique(np.stack([node, ids], axis=1), axis=0)
    begins = np.searchsorted(pairs[:, 0], np.arange(len(vectors) + 1))
    layers = build(scaled(vectors, exponent(vectors)))
    return pa.table(
        [
            pa.array([rows["shard"][0].as_py()], pa.int32()),
            pa.array([dim], pa.int32()),
            pa.array([np.ascontiguousarray(pairs[:, 1]).tobytes()], pa.binary()),
            pa.array([begins.astype(np.int64).tobytes()], pa.binary()),
            pa.array([vectors.tobytes()], pa.binary()),
            pa.array([[x.nodes.astype(np.int32).tobytes() for x in layers]], pa.list_(pa.binary())),
            pa.array([[x.links.tobytes() for x in layers]], pa.list_(pa.binary())),
        ],
        ["shard", "dim", "ids", "rows", "vectors", "nodes", "links"],
    )


def search_index(index: dict, own: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's row, vec_id, score) of up to k neighbours of each query, or a few more, in one index."""
    ids, begins = (np.frombuffer(index[c], np.int64) for c in ("ids", "rows"))
    vectors = np.frombuffer(index["vectors"], np.float64).reshape(-1, index["dim"])
    by = exponent(vectors)
    v_scaled, layers = scaled(vectors, by), []
    for x, y in zip(index["nodes"], index["links"], strict=True):
        nodes = np.frombuffer(x, np.int32).astype(np.int64)
        layers.append(Layer(v_scaled, nodes, np.frombuffer(y, np.int32).reshape(len(nodes), -1)))
    found = search(layers, scaled(q, by), k + 1)
    # of equal vectors only the k smallest ids can be among the k nearest, or one more if the query is one of them
    row = np.repeat(np.arange(len(own)), found.shape[1])
    node = found.ravel()
    score = distance(vectors[node], q[row])
    many = np.minimum(begins[node + 1] - begins[node], k + 1)
    at = np.repeat(begins[node] - np.cumsum(many) + many, many) + np.arange(many.sum())
    row, vec, score = np.repeat(row, many), ids[at], np.repeat(score, many)
    other = vec != own[row]
    return row[other], vec[other], score[other]


def search_shard(indexes: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """A block's queries in one shard, whose classes of sizes have an index each: up to k neighbours, scored in double precision."""
    if not indexes.num_rows or not queries.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["query_id", "vec_id", "score"])
    own = queries["vec_id"].to_numpy()
    q = queries["v"].combine_chunks().flatten().to_numpy().reshape(len(own), -1)
    each = [search_index(indexes.slice(i, 1).to_pylist()[0], own, q, k) for i in range(indexes.num_rows)]
    row, vec, score = (np.concatenate(x) for x in zip(*each, strict=True))
    order = np.lexsort((vec, score, row))
    row, vec, score = row[order], vec[order], score[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return pa.table([pa.array(own[row[best]]), pa.array(vec[best]), pa.array(score[best])], ["query_id", "vec_id", "score"])


def neighbours(vectors: DataFrame, is_query: Column, k: int = 10, embedding: str = "embedding", least: int = LEAST, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found by Euclidean distance for every row that is_query marks.

    Vectors are dealt to shards by a hash of vec_id and vector: about `least` in each while those make few tasks, beyond
    that more, up to `most`. A shard's graph is stored as flat arrays in one row of a table. Queries go through every
    shard in blocks about as large as an index, and the shards' results are merged: nearest first, ties to the
    smaller vec_id. Distances are differences in double precision, in the graph too, so vectors far from zero are found like any
    other. Vectors of a size that most others don't have (2 ** 200 or 2 ** -200, and every 2 ** 400 from there) have a graph of
    their own in each shard.

    Vectors that are null, empty or zero or hold null or non-finite components take no part, nor do rows without vec_id.
    Only vectors of one length are compared. Rows that repeat in vec_id and vector are one; other vectors of one
    vec_id are each for themselves, and a query never finds its own vec_id. Equal vectors are one node, and all
    their ids are found. No vectors: no rows. Other columns are not read, but by is_query.
    """
    prepare(vectors.sparkSession)
    v = F.col(embedding).cast("array<double>")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(embedding))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"), F.size(embedding).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = materialise(rows.distinct(), "vectors")
    n, asked, dim = rows.agg(F.count(F.lit(1)), F.count_if("is_query"), F.coalesce(F.max("dim"), F.lit(1))).first()
    most = max(1, min(most, SHARD_BYTES // (8 * dim)))
    shards, blocks = max(-(-n // most), min(TASKS, -(-n // least)), 1), max(-(-asked // block), 1)
    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")
    index = materialise(rows.select("vec_id", "v", "dim", shard.alias("shard"), size_class("v").alias("size")).groupBy("shard", "dim", "size").applyInArrow(index_shard, INDEX), "index")
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = rows.where("is_query").select("vec_id", "v", "dim", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("block"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    key = ["shard", "dim", "block"]
    found = index.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(lambda x, y: search_shard(x, y, k), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
