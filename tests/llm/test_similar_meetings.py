"""Only sets that share enough of their least shingles get fingerprints, which meet half way instead of being searched for."""

import time

import numpy as np
import pyarrow as pa
import pytest

from handbill.llm import similar

R = np.random.default_rng(6)


@pytest.mark.parametrize("most", [similar.MEET, 50])
def test_meetings_are_all_pairs(monkeypatch, most):
    monkeypatch.setattr(similar, "MEET", most)
    for n, bits in ((400, 6), (2000, 12), (3000, 24), (1, 24)):
        code = (R.integers(0, 1 << bits, n) << (24 - bits)).astype(np.uint32)
        group = np.where(R.random(n) < 0.3, 0, np.arange(n))
        near = (np.bitwise_count(code[:, None] ^ code[None, :]) <= 2) & (group[:, None] != group[None, :])
        found = [tuple(sorted(p)) for i, j in similar.meetings(code, group) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert len(found) == len(set(found)) and set(found) == set(zip(*(x.tolist() for x in np.nonzero(np.triu(near))), strict=True))


def test_large_shard():
    """200,000 unlike sets in one shard: codes aren't compared one by one."""
    n = 200_000
    shard = pa.table({"fp": np.arange(n), "code": R.integers(0, 1 << 24, n), **{f"n{k}": R.integers(-(2**63), 2**63 - 1, n) for k in range(3)}})
    began = time.process_time()
    similar.shard_pairs(shard, 40)
    assert time.process_time() - began < 6


def test_unlike_sets_get_no_fingerprints(spark, monkeypatch):
    marked, kept = [], similar.marks
    monkeypatch.setattr(similar, "marks", lambda texts, *rest: kept(texts, *rest) if marked.append({r["text"] for r in texts.collect()}) is None else None)
    words = [f"w{i}" for i in range(400)]
    lone = [" ".join(R.permutation(words)[: 8 + 3 * k]) + " all rights reserved by the owner" for k in range(40)]
    near = [" ".join(R.permutation(words)[:n]) for n in (9, 30, 90, 300)]
    near += [x + " end" for x in near]
    docs = spark.createDataFrame(list(enumerate(lone + near + near)), "doc_id long, text string")
    assert similar.near_duplicates(docs).where("doc_id <> component_id").count() == 12
    assert marked == [set(near)]


def test_least_shingles_of_alike_sets():
    """Of pairs at 0.8 none shares fewer of its least shingles than suspects() asks for."""
    enough = similar.shared_least(80)
    assert enough == 6 and similar.shared_least(30) == 0
    for both, a, b in [(4, 0, 1), (15, 0, 3), (20, 0, 5), (24, 3, 3), (32, 0, 8), (40, 5, 5), (400, 100, 0)] * 60:
        held = R.integers(0, 2**64, both + a + b, dtype=np.uint64)
        one, other = np.sort(held[: both + a]), np.sort(np.concatenate([held[:both], held[both + a :]]))
        shared = len(np.intersect1d(one[: similar.LEAST], other[: similar.LEAST]))
        assert all(shared >= min(-(-80 * len(x) // 100), enough) for x in (one, other))
