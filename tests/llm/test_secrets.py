"""Secret scans: patterns against plain ones, automata against their sums, and held-out credentials."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from handbill.llm import queries, secrets

LETTERS = "etaoinshrdlucmfwypvbgk"


def plain(text):
    """The contract's patterns as they stand."""
    text, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out)


def test_base_spans():
    r = random.Random(1)
    parts = ["password", "PassWD", "secret", "token", "api_key", "ApiKey", "=", ":", " ", "'", '"', "AKIA", "AKIAAKIA1", "a" * 7, "deadbeef" * 4, "f" * 31, "Z9" * 7, "é", "\U0001f600", "\n", "_x.=-", "ſecret", "toKen"]
    for _ in range(4000):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert [(s, k, e) for s, e, k, _ in secrets.base_spans(text)] == plain(text), text
        assert secrets.Scanner().look(text)[0] == secrets.base_spans(text)


def test_probabilities_sum_to_one_and_batches_agree():
    r = random.Random(2)
    a = secrets.Automaton(["".join(r.choices("0123456789abcdef", k=r.randint(4, 12))) for _ in range(300)])
    assert np.allclose(np.exp(a.log).sum(axis=1) + np.exp(a.log_end), 1)
    values = ["", "a", "zz", "00ff", "é9"] + ["".join(r.choices(secrets.ALPHABET, k=r.randint(1, 30))) for _ in range(50)]

    def one(value):
        state, total = 0, 0.0
        for c in value:
            k = secrets.ALPHABET.index(c) if c in secrets.ALPHABET else len(secrets.ALPHABET)
            total, state = total + a.log[state, k], a.to[state, k]
        return total + a.log_end[state]

    assert np.allclose(a.score(values), [one(v) for v in values])


def test_merging_keeps_counts_and_finds_the_grammar():
    """Words of (ab)*c: two states and an end, and no count is lost in folding."""
    values = ["ab" * k + "c" for k in range(6) for _ in range(2 ** (8 - k))]
    a = secrets.Automaton(values)
    assert len(a.states) == 3
    assert sum(a.ends[s] for s in a.states) == len(values)
    assert sum(sum(a.edge[s].values()) for s in a.states) == sum(map(len, values))
    hexes = secrets.Automaton(["".join(random.Random(k).choices("0123456789abcdef", k=40)) for k in range(500)])
    keys = secrets.Automaton(["AKIA" + "".join(random.Random(k).choices("ABC123", k=12)) for k in range(500)])
    assert len(hexes.states) <= 3 < len(keys.states)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    word = lambda: "".join(r.choices(LETTERS, k=r.randint(3, 12)))
    text = lambda *more: " ".join([*(word() for _ in range(40)), *more, *(word() for _ in range(20))])
    digits = lambda k: "".join(r.choices("0123456789abcdef", k=k))
    made = [text(f"password={digits(18)}") for _ in range(60)] + [text(f'token = "{digits(40)}"') for _ in range(60)]
    made += [text("AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))) for _ in range(60)]
    made += [text(str(r.randrange(10**15, 10**16)), f"555-{r.randrange(1000, 9999)}", f"mail{k % 9}.example.com") for k in range(120)]
    bare = [text(digits(20), "Ab") for _ in range(40)]
    return made, bare


def test_held_out_formats(spark, rows):
    """Formats learnt from labelled credentials are found where no pattern matches; ordinary text is left alone."""
    made, bare = rows
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(4)
    model = secrets.fit(docs)
    found = secrets.find_secrets(spark.createDataFrame(list(enumerate(bare)), "doc_id long, text string"), model).collect()
    hits = [[s for s in x["secrets"] if s["kind"] == "format"] for x in found]
    assert sum(len(h) == 1 and h[0]["end"] - h[0]["start"] == 20 for h in hits) >= 36
    own = secrets.find_secrets(docs, model).collect()
    assert sum(any(s["kind"] == "format" for s in x["secrets"]) for x in own) <= 3
    for x in own + found:
        base = [s for s in x["secrets"] if s["kind"] != "format"]
        assert [(s["start"], secrets.KINDS.index(s["kind"]), s["end"]) for s in base] == plain(x["text"])
        spans = sorted((s["start"], s["end"]) for s in x["secrets"])
        assert all(s["kind"] != "format" or all(s is t or s["end"] <= t["start"] or t["end"] <= s["start"] for t in x["secrets"]) for s in x["secrets"]), spans


def test_scanning_by_words_is_scanning_whole_texts(spark, rows, monkeypatch):
    """What is remembered between texts changes nothing: every candidate of a text is scored."""
    made, bare = rows
    texts = (made + bare) * 2 + [f"{bare[0].split()[40]} x password=abcdefgh{bare[1].split()[40]}", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    model = secrets.fit(docs)
    found = {x["doc_id"]: [(s["start"], s["end"]) for s in x["secrets"] if s["kind"] == "format"] for x in secrets.find_secrets(docs, model).collect()}
    for i, t in enumerate(texts):
        each = list(secrets.candidates(t, secrets.base_spans(t)))
        gains, _ = model.margins([v for _, _, v in each])
        assert found[i] == [(s, e) for (s, e, _), g in zip(each, gains, strict=True) if g >= secrets.MARGIN]


def test_query_and_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, "token=abcdefgh"), (3, "AKIAABCDEFGHIJKL " + "0" * 32), (3, "AKIAABCDEFGHIJKL " + "0" * 32), (4, "é \U0001f600 secret: 12345678"), (5, "word " * 5000)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("secrets", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op12_secrets(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = []
    for doc_id, text in rows:
        base = plain(text)
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        want.append((doc_id, *(sum(k == j for _, k, _ in base) for j in range(3)), hashlib.sha256(joined.encode()).hexdigest()))
    got = found.collect()
    assert sorted((tuple(x)[:5] for x in got), key=repr) == sorted(want, key=repr)
    assert all(x["spans"].startswith("assign:4:20") for x in got if x["doc_id"] == 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert secrets.find_secrets(docs.where("false")).count() == 0
    assert {len(x["secrets"]) for x in secrets.find_secrets(docs.where("doc_id = 5")).collect()} == {0}
