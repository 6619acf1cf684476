"""Ids of texts whose parts don't repeat, and of long ones, against the library."""

import random

from handbill.llm import tokens


def test_whole_texts_and_long_ones():
    r = random.Random(2)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyzß<|>0.,", k=r.randint(1, 12)))
    texts = ["", " ", "x", *(" ".join(word() for _ in range(n)) for n in (5, 300, 40_000)), "\n".join(word() for _ in range(30_000)), "a" * 150_000, "end <|endoftext|> " * 9_000]
    encoder = tokens.Encoder(tokens.byte_bpe_path())
    expected = [len(encoder.library.encode(x, add_special_tokens=False).ids) for x in texts]
    assert any(len(tokens.long_parts(x)) > 2 for x in texts) and all("".join(tokens.long_parts(x)) == x for x in texts)
    for direct in (0, 10_000):
        encoder.direct = direct
        assert encoder.counts(texts) == expected and [len(x) // 4 for x in encoder.encode(texts)] == expected
    assert encoder.counts(texts, [1 << 20] * len(texts)) == expected


def test_new_parts_send_whole_texts_to_the_library():
    encoder = tokens.Encoder(tokens.byte_bpe_path())
    encoder.counts([" ".join(f"q{i}z{i * 7919 % 10007}" for i in range(5_000))])
    assert encoder.direct == tokens.DIRECT
    encoder = tokens.Encoder(tokens.byte_bpe_path())
    encoder.counts(["the same words again and again " * 2_000])
    assert encoder.direct == 0
