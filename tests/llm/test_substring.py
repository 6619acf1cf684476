"""Repeated windows against brute force where one passage stands in ever other surroundings."""

import random

import numpy as np
import pytest

from handbill.llm import substring


def brute(texts, window=20):
    seen, out = set(), []
    for t in texts:
        w = t.split()
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            gone[i : i + window] |= key in seen
            seen.add(key)
        out.append((len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("crowd", [3, 20, 2_000])
def test_one_passage_in_many_surroundings(spark, monkeypatch, crowd):
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)]
    passage, stutter = r.choices(vocabulary, k=33), ["a", "b"] * 14
    texts = []
    for i in range(160):
        cut = r.randint(0, 6)
        core = [passage[cut : 33 - r.randint(0, 5)], stutter[i % 2 :], passage + passage, ["c"] * r.randint(15, 60)][i % 4]
        texts.append(" ".join(r.choices(vocabulary, k=r.randint(0, 30)) + core + r.choices(vocabulary, k=r.randint(0, 30))))
    monkeypatch.setattr(substring, "CROWD", crowd)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept"]) for x in substring.remove_repeats(docs).collect()}
    assert found == dict(enumerate(brute(texts)))


def test_keys_do_not_depend_on_surroundings():
    r = np.random.default_rng(2)
    words = [f"w{i}" for i in r.integers(0, 6, 60)]
    for order in (1, 2, 4, 8, None):
        w = substring.Words([" ".join(words[:45]).encode(), " ".join(["x", *words[5:]]).encode()])
        at = w.windows(20)
        keys = dict(zip(zip(w.of[at].tolist(), (at - w.first[w.of[at]]).tolist(), strict=True), w.keys(at, 20, order).tolist(), strict=True))
        assert all(keys[0, i] == keys[1, i - 4] for i in range(5, 26))


def test_thue_morse_words_are_not_equal(spark):
    """A word of 1,024 letters by the parity of bits, and its complement: sums of powers modulo 2 ** 64 can't tell them apart."""
    odd = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = odd.translate(str.maketrans("ab", "ba"))
    head = " ".join(f"w{i}" for i in range(19))
    texts = [f"{head} {odd}", f"{head} {other}", " ".join(["x", "y"][i.bit_count() % 2] for i in range(2048)), " ".join(["y", "x"][i.bit_count() % 2] for i in range(2048)), f"{head} {odd}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept"]) for x in substring.remove_repeats(docs).collect()}
    assert found == dict(enumerate(brute(texts)))
    assert found[1][1] == 0 and found[4][1] == 20


@pytest.mark.parametrize("bits", [2, 5, 10])
def test_weak_hashes_change_nothing(spark, bits):
    r = random.Random(bits)
    vocabulary = [f"w{i}" for i in range(12)]
    passages = [r.choices(vocabulary, k=r.randint(22, 60)) for _ in range(4)]
    texts = [" ".join(r.choices(vocabulary, k=r.randint(0, 40)) + (r.choice(passages) if i % 2 else []) + r.choices(vocabulary, k=r.randint(0, 40))) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept"]) for x in substring.remove_repeats(docs, bits=bits).collect()}
    assert found == dict(enumerate(brute(texts)))
