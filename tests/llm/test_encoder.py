"""What an encoder forgets, which texts it looks at twice, groups of both kinds, batches that go together."""

import random

import pyarrow as pa
import pyarrow.compute as pc

from handbill.llm import common, tokens


def some_texts(r, n, alphabet):
    return ["".join(r.choices(alphabet, k=r.choice([0, 1, 2, 5, 60]))) for _ in range(n)]


def test_runs_are_found_by_arrow_too():
    r = random.Random(4)
    texts = some_texts(r, 20_000, " \n\t\r\x0b\x1c\x1f\x85\xa0  ​   　,._aZ9-ß×÷éɏʼжд中²𝟗́") + ["a, b", "é. B"]
    maybe = pc.match_substring_regex(pa.array(texts), tokens.MAYBE_RUNS).to_pylist()
    assert all(found for x, found in zip(texts, maybe, strict=True) if tokens.RUNS.search(x))
    assert maybe[-2:] == [False, False]


def test_ids_and_counts_of_texts_of_both_kinds(monkeypatch):
    r = random.Random(5)
    texts = some_texts(r, 3_000, "   \n,.aéжZ9-_中\xa0'<|") + ["one <|endoftext|> two", "<|endoftext|>", "ends.\n", "\nopens", ",", "x" * 200] * 2
    r.shuffle(texts)
    monkeypatch.setattr(tokens, "FRESH", 2.0)  # the library gets no whole texts
    monkeypatch.setattr(tokens, "JOINED", 7)
    for kept, huge in ((110_000_000, 1 << 26), (20_000, 1 << 26), (0, 40)):
        monkeypatch.setattr(tokens, "KEPT_CHARS", kept)
        monkeypatch.setattr(tokens, "HUGE_BYTES", huge)
        encoder = tokens.Encoder(tokens.byte_bpe_path())
        expected = encoder.one_by_one(texts)
        for sizes in (None, [tokens.GROUP_BYTES // 100] * len(texts)):
            assert encoder.encode(texts, sizes) == expected
            assert encoder.counts(texts, sizes) == [len(x) // 4 for x in expected]


def test_frequent_parts_are_not_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_CHARS", 100_000)
    encoder = tokens.Encoder(tokens.byte_bpe_path())
    common_words = " ".join(f"often{i}" for i in range(100))
    for k in range(5):
        encoder.counts([" ".join([common_words] * 10 + [f"seldom{k}x{i}" for i in range(150)])])
    encoder.counts([" ".join(f"once{i}" for i in range(2_000))])
    encoder.direct = 0
    encoder.counts([common_words] * 3)
    assert encoder.fresh == 0 and 0 < encoder.held <= 100_000


def test_small_batches_go_together():
    batches = [pa.record_batch({"x": pa.array(range(n), pa.int64())}) for n in (0, 3, 0, 4, 100, 2)]
    assert [b.num_rows for b in common.gathered(iter(batches), 50)] == [7, 100, 2]
    assert [b.num_rows for b in common.gathered(iter(batches), 0)] == [3, 4, 100, 2]
    assert list(common.gathered(iter(batches[:1]), 50)) == []
