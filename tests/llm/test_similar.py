import random
import time

import numpy as np
import pytest

import corpus_pipeline
from handbill.llm import similar


@pytest.mark.parametrize("crowd, shingles", [(similar.CROWD, similar.CROWD_SHINGLES), (7, similar.CROWD_SHINGLES), (similar.CROWD, 900)])
def test_near_duplicate_stage(spark, monkeypatch, crowd, shingles):
    monkeypatch.setattr(similar, "CROWD", crowd)
    monkeypatch.setattr(similar, "CROWD_SHINGLES", shingles)
    r = random.Random(4)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(2, 6))) for _ in range(400)]
    texts = [None, "", " \t", "two words", "Two  Words"]
    for _ in range(12):  # a hot group beside pairs
        texts.append(" ".join(r.choices(vocabulary, k=r.choice([30, 120, 400]))))
    for base in texts[5:]:
        for changes in [0, 1, 2, 4, 8, 12, 20, 40]:
            w = base.split()
            for _ in range(changes):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w))
    hot = texts[16].split()
    for _ in range(60):
        i = r.randrange(len(hot))
        texts.append(" ".join(hot[:i] + r.choices(vocabulary, k=r.randint(0, 12)) + hot[i:]))
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) >= 0.8 * len(a | b):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(label))
    assert similar.near_duplicates(docs.where("false")).count() == 0
    assert {x["doc_id"]: x["component_id"] for x in similar.near_duplicates(docs).collect()} == dict(enumerate(label))


def test_main_hubs():
    assert similar.main_hubs([(0, 50), (1, 10), (2, 4), (6, 3), (8, 9), (9, 1)]) == 9
    assert similar.main_hubs([(0, 5)]) == 0 and similar.main_hubs([(1, 2), (2, 2), (3, 1), (4, 4)]) == 3


def test_forests_against_all_pairs():
    """Components of buckets by rarest shingles are those of all pairs, at the threshold itself too."""
    r = np.random.default_rng(3)
    for percent in (50, 80, 100):
        base = np.sort(r.choice(400, 40, replace=False))
        held = []
        for _ in range(60):
            own = set(base[: r.integers(5, 41)].tolist())
            for _ in range(r.integers(0, 12)):
                own ^= {int(r.integers(0, 400))}
            held.append(np.array(sorted(own or {1}), np.uint64))
        held = [np.frombuffer(x, np.uint64) for x in dict.fromkeys(h.tobytes() for h in held)]
        fp = np.arange(len(held))
        label = fp.copy()
        for i in fp:
            for j in range(i):
                both = len(np.intersect1d(held[i], held[j]))
                if 100 * both >= percent * (len(held[i]) + len(held[j]) - both):
                    label[label == max(label[i], label[j])] = min(label[i], label[j])
        a, b = similar.bucket_links(fp, held, percent)
        root = fp.copy()
        root[a] = b
        assert len(np.unique(root)) == len(np.unique(label))
        assert all(len(np.unique(root[label == x])) == 1 for x in label)


def test_large_sets_below_the_threshold():
    """400 sets of 20,000 shingles, of which 15,000 are common: no two are alike, and none has to be counted."""
    common = np.arange(15_000, dtype=np.uint64)
    held = [np.concatenate([common, np.arange(5_000, dtype=np.uint64) + np.uint64(20_000 + 5_000 * k)]) for k in range(400)]
    began = time.perf_counter()
    a, _ = similar.bucket_links(np.arange(400), held, 80)
    assert not len(a) and time.perf_counter() - began < 15
