"""Runs of words against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from handbill.llm import queries, runs


def brute(w, least=12):
    """Every maximal stretch for every period, the least period first."""
    out, seen = [], set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(r, count):
    for k in range(count):
        n, letters = r.randint(0, 80), r.choice([1, 2, 2, 3, 4])
        if k % 4 == 0:
            w = [r.randrange(letters) for _ in range(n)]
        elif k % 4 == 1:
            w = []
            while len(w) < n:
                w += [r.randrange(letters) for _ in range(r.randint(1, 9))] * r.randint(1, 6)
                w += w[-r.randint(1, 12) :]
        elif k % 4 == 2:
            a, b = [0], [0, 1]
            for _ in range(r.randint(2, 8)):
                a, b = b, b + a
            w = b[:n]
        else:
            w = [i.bit_count() % 2 for i in range(n)] + [r.randrange(2) for _ in range(r.randint(0, 30))]
        yield w


def test_against_brute_force():
    r = random.Random(1)
    for w in sequences(r, 800):
        least = r.choice([2, 4, 12])
        assert [tuple(x) for x in runs.runs(np.array(w, np.int64), least).tolist()] == brute(w, least), (w, least)


def test_shared_dictionaries(monkeypatch):
    r = random.Random(2)
    texts = [" ".join("ab"[x % 2] for x in w).encode() for w in sequences(r, 120)]
    for size in (1, 50, 1 << 16):
        monkeypatch.setattr(runs, "BLOCK_WORDS", size)
        for text, (words, found) in zip(texts, runs.text_runs(texts), strict=True):
            assert words == text.split() and [tuple(x) for x in found.tolist()] == brute(words)


def test_long_repetitive_texts():
    """One word, one long period, and a word without cubes: no list of pairs of places."""
    assert runs.runs(np.zeros(100_000, np.int64)).tolist() == [[0, 100_000, 1]]
    assert runs.runs(np.arange(50_000) % 999).tolist() == [[0, 50_000, 999]]
    thue = np.array([i.bit_count() % 2 for i in range(1 << 14)])
    assert len(runs.runs(thue)) < len(thue)


def expected(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, sha("".join(f"{s},{size},{q}\n" for s, size, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["a", "b c", "\U0001f600", "é"]) + r.choice(["", "", "\n", "\t "]) for _ in range(r.randint(0, 60)))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, " \n\t"), (None, "x y " * 20), (1, rows[1][1]), (None, None), (-7, "one two three"), (10, "same " * 500)]
    made = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).repartition(3)
    made.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((expected(*x) for x in rows), key=repr)


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 10, "kept")], "doc_id long, text string, Collapsed string").withColumn("n", F.lit(5))
    row = runs.collapse_runs(docs).first()
    assert (row["n"], row["collapsed"], [tuple(x) for x in row["runs"]]) == (5, "a b", [(0, 20, 2)])
    assert runs.collapse_runs(docs.where("false")).count() == 0
