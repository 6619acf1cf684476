"""The packing program on histograms: how much it places, how its plans compare to best-fit decreasing and to the bound."""

import numpy as np
import pytest

from handbill.llm import packing

R = np.random.default_rng(1)


def counted(lengths) -> np.ndarray:
    return np.bincount(lengths, minlength=1025)[1:1025]


HISTOGRAMS = {
    "documents": counted(np.minimum(R.geometric(1 / 300, 5000), 1024)) + counted([1024] * 4000),
    "uniform": counted(R.integers(1, 1025, 50_000)),
    "large": counted(R.integers(1, 1025, 500_000)),
    "halves": counted(R.integers(400, 701, 20_000)),
    "thirds": counted(R.integers(300, 401, 20_000)),
    "one length": counted([600] * 1000),
    "few": counted([1, 5, 1000, 1024, 512, 512, 512]),
}


def best_fit_decreasing(counts: np.ndarray) -> int:
    gaps: list[int] = []
    from bisect import bisect_left, insort

    for length in range(1024, 0, -1):
        for _ in range(counts[length - 1]):
            at = bisect_left(gaps, length)
            insort(gaps, (gaps.pop(at) if at < len(gaps) else 1024) - length)
    return len(gaps)


@pytest.mark.parametrize("name", HISTOGRAMS)
def test_plan(name):
    counts = HISTOGRAMS[name]
    found = packing.plan(counts, 1024)
    held = np.zeros(1024, np.int64)
    for pattern, times in found.patterns:
        assert times > 0 and sum(n * k for n, k in pattern) <= 1024
        for n, k in pattern:
            held[n - 1] += k * times
    assert (held == counts).all()
    assert found.bound - 1e-6 <= found.sequences
    if counts.sum() <= 50_000:
        assert found.sequences <= best_fit_decreasing(counts)
    assert found.placed >= 0.9 or name == "few", (found.placed, found.sequences)


def test_bound_is_the_program_s_optimum():
    # 600 does not go twice into 1,024; three of 340 do
    assert packing.plan(counted([600] * 50), 1024).bound == pytest.approx(50)
    assert packing.plan(counted([340] * 300), 1024).bound == pytest.approx(100)


def test_pricing_against_enumeration():
    for _ in range(20):
        worth = np.zeros(31)
        worth[R.integers(1, 31, 5)] = R.random(5) + 0.1
        value, took = packing.price(worth, 30)
        plain = np.full(31, -np.inf)
        plain[0] = 0
        for c in range(1, 31):
            plain[c] = max([plain[c - n] + worth[n] for n in range(1, c + 1) if worth[n]], default=-np.inf)
        assert value == pytest.approx(plain)
        assert all(worth[took[c]] > 0 for c in range(1, 31) if np.isfinite(value[c]))


def test_nothing():
    assert packing.plan(np.zeros(1024, np.int64), 1024).patterns == []
