import tracemalloc
from collections import Counter

import numpy as np
import pytest

from handbill.llm import toxicity

WORDS = [f"{a}{b}{c}{d}" for a in "bdfgklmnp" for b in "aeiou" for c in "rstvz" for d in "aeinou"]


def texts(n: int, length: int, seed: int = 3) -> tuple[list[bytes], np.ndarray]:
    """Sentences of up to 40 words, of which toxic documents have some of their own, and some that is in no other."""
    r = np.random.default_rng(seed)
    toxic = (r.random(n) < 0.2).astype(np.int64)
    out = []
    for i, y in enumerate(toxic):
        words = [WORDS[k] for k in r.integers(0, len(WORDS), length)]
        if y:
            words[:: length // 8] = [f"vilest{'xyz'[k]}" for k in r.integers(0, 3, len(words[:: length // 8]))]
        words[-1] = f"only{i}. "
        out.append(" ".join(w + "." * (r.random() < 0.05) for w in words).encode())
    return out, toxic


def test_fit_needs_little_memory():
    docs, toxic = texts(600, 300)
    tracemalloc.start()
    tagger = toxicity.fit(docs, toxic, rounds=1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tagger.weights
    assert most < 25 * sum(map(len, docs))


@pytest.mark.parametrize("cells", [1, 50, 1 << 17])
def test_marks_against_sets(monkeypatch, cells):
    docs, toxic = texts(60, 24)
    docs[5], docs[6], toxic[6] = b"", docs[7], toxic[7]
    monkeypatch.setattr(toxicity, "CELLS", cells)
    coded = toxicity.Coded(docs)
    with_it, before = [Counter(), Counter()], {}
    for text, y in zip(docs, toxic.tolist(), strict=True):
        tokens = [w.lower() for s in toxicity.sequences_of(text.decode()) for w in s]
        with_it[y].update({f for w in tokens for f in toxicity.features(w)})
        for a, w in zip([b"", *tokens], tokens, strict=False):
            for f in toxicity.features(w) if y else []:
                before.setdefault(f, set()).add(a)
    for least, purity in ((6, 0.93), (2, 0.5), (1, 1.0)):
        expected = {f for f, x in before.items() if len(x) >= least and with_it[1][f] >= purity * (with_it[0][f] + with_it[1][f])}
        found = toxicity.suspicious(coded, toxic, least, purity)
        assert {f for f, x in zip(coded.names, found, strict=True) if x} == expected
        assert expected
