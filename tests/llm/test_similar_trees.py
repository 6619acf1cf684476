"""Candidates of near duplicates come from vantage-point trees over fingerprints, whatever the sizes of the sets."""

import numpy as np
import pytest

import corpus_pipeline
from handbill.llm import similar, simhash

R = np.random.default_rng(8)


def pairs():
    """Sets of similarity 0.8 or just above, as (common, of one alone, of the other alone), among lone ones."""
    shapes = [(4, 0, 1), (8, 1, 1), (12, 0, 3), (15, 0, 3), (16, 0, 4), (16, 2, 2), (20, 2, 3), (32, 0, 8), (40, 5, 5), (400, 0, 100), (800, 100, 100)]
    for both, a, b in shapes * 12:
        held = R.integers(0, 2**64, both + a + b, dtype=np.uint64)
        yield np.sort(held[: both + a]), np.sort(np.concatenate([held[:both], held[both + a :]]))


def test_classes_meet():
    for percent in (30, 80, 95):
        for size in range(1, 400):
            for other in range(-(-percent * size // 100), size + 1):
                assert set(similar.classes_of(size, percent)) & set(similar.classes_of(other, percent))


def test_fingerprints_needed():
    trees, apart = similar.trees_for(80)
    assert trees == 64 and (1 - similar.odds(24, 0.1582, 2)) ** trees < 2e-8 and 1 - similar.odds(192, 0.1582, apart) < 2e-9


@pytest.mark.parametrize("most", [similar.MOST, 40])
def test_trees_find_what_is_alike(spark, monkeypatch, most):
    monkeypatch.setattr(similar, "MOST", most)
    trees, _ = similar.trees_for(80)
    votes = np.arange(similar.VOTES, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    made = [x for pair in pairs() for x in pair]
    rows = []
    for i, held in enumerate(made):
        small = similar.fingerprints((held[:, None] + votes).ravel(), trees)
        rows.append((i, similar.classes_of(len(held), 80), bytearray(similar.fingerprints(held, trees)), bytearray(small)))
    nodes = spark.createDataFrame(rows, "fp long, classes array<int>, bits binary, small binary").repartition(3)
    found = {(r["a"], r["b"]) for r in similar.candidates(nodes, 80).collect()}
    assert found == {(i + 1, i) for i in range(0, len(made), 2)}


def test_stage_lays_out_trees(spark, monkeypatch):
    laid = []
    monkeypatch.setattr(similar, "MOST", 20)
    monkeypatch.setattr(similar, "layout", lambda sample: laid.append(len(sample)) or simhash.layout(sample))
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(R.permutation(words)[:60]) for _ in range(50)]
    texts += [t + " end" for t in texts[:30]]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(range(50)) and len(laid) >= similar.trees_for(80)[0]
