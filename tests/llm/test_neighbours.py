"""Graph search against brute force: many shards, vectors far from zero or of extreme size, few or alike vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from handbill.llm import ann

R = np.random.default_rng(6)
PLAIN = R.standard_normal((1500, 16))
INPUTS = {
    "plain": PLAIN,
    "large": PLAIN * 1e20,
    "small": PLAIN * 1e-30,
    "huge": PLAIN * 1e200,
    "offset": 100 + 0.01 * PLAIN,
    "clusters": PLAIN[R.integers(0, 12, 1500)] + 0.01 * PLAIN,
    "one far off": np.concatenate([PLAIN[:-1], PLAIN[-1:] * 1e20]),
    "one at 1e200 among ordinary": np.concatenate([PLAIN[:-1], PLAIN[-1:] * 1e200]),
    "all sizes": PLAIN * 10.0 ** R.integers(-300, 300, (1500, 1)),
    "mostly equal": np.where(np.arange(1500)[:, None] % 3 == 0, PLAIN[:1], PLAIN),
}


def exact(v: np.ndarray, query: int, k: int) -> tuple[list[int], np.ndarray]:
    d = ann.distance(v, np.repeat(v[query : query + 1], len(v), 0))
    return [int(i) for i in np.lexsort((np.arange(len(v)), d)) if i != query][:k], d


@pytest.mark.parametrize("name", INPUTS)
def test_recall_over_shards(spark, name):
    v = INPUTS[name]
    table = spark.createDataFrame([(i, x.tolist(), "s", 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, shard string, block int")
    found: dict[int, list] = {}
    for r in ann.neighbours(table, F.col("vec_id") % 50 == 0, least=200, block=10).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q, own in found.items():
        best, d = exact(v, q, 10)
        assert [r for r, _, _ in own] == list(range(1, 11)) and [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        assert all(s == pytest.approx(d[i], rel=1e-12) for _, i, s in own)
        hits += sum(s <= d[best[-1]] for _, _, s in own)
    assert set(found) == set(range(0, 1500, 50)) and hits >= 0.95 * 300


def test_large_shard():
    v = R.standard_normal((6000, 16))
    layers = ann.build(v)
    assert len(layers) > 2 and all(x.links.max() < len(x.nodes) for x in layers)
    found = ann.search(layers, v[:60], 11)
    assert sum(len({i for i in found[q].tolist() if i != q} & set(exact(v, q, 10)[0])) for q in range(60)) >= 0.95 * 600


def test_shard_of_64_dimensions_above_least():
    """More than LEAST vectors in one shard, as many dimensions as embeddings have."""
    v = R.standard_normal((ann.LEAST + 900, 64))
    found = ann.search(ann.build(v), v[:40], 11)
    assert sum(len({i for i in found[q].tolist() if i != q} & set(exact(v, q, 10)[0])) for q in range(40)) >= 0.9 * 400


def test_fewer_than_asked_and_repeats(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 5)] + [(1, [1.0, 1.0])] * 3 + [(2, [9.0, 9.0]), (7, [1.0])]
    found = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 1)
    assert [(r["rank"], r["vec_id"]) for r in found.orderBy("rank").collect()] == [(1, 2), (2, 3), (3, 4), (4, 2)]
