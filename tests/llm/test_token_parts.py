"""Which texts are cut by the slow pattern, and ids of new parts of every kind."""

import random
import re

from handbill.llm import tokens


def test_runs_as_said():
    r = random.Random(1)
    for _ in range(20_000):
        x = "".join(r.choices(" \n\t,._aß9- ", k=r.randint(0, 6)))
        assert bool(tokens.RUNS.search(x)) == bool(re.search(r"\s\s|[\W_][,.]", x)), repr(x)


def test_ids_of_new_parts(monkeypatch):
    monkeypatch.setattr(tokens, "CHAIN_CHARS", 40)
    r = random.Random(2)
    texts = ["", " ", "ends in a space ", "x" * 100, *(" ".join("".join(r.choices("abß,.\t9", k=r.randint(1, 30))) for _ in range(20)) + "\n" for _ in range(60))]
    encoder = tokens.Encoder(tokens.byte_bpe_path())
    assert encoder.encode(texts) == encoder.one_by_one(texts)
