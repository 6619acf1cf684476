"""The manifest against a plain tree over whole lists."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from handbill.llm import merkle, queries


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def up(level):
    """All levels over a list of digests."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def beside(levels, at):
    """(before, after) on each level below the top."""
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        at //= 3
    return out


def plain(rows):
    def digest(row, text):
        values = [*row[:4], text]
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    trees = {}
    for doc_id, source, lang, n, text in rows:
        other = text.replace("\n", "") if text and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 else text
        row = (doc_id, source, lang, n)
        trees.setdefault(source, []).append((doc_id is not None, doc_id or 0, digest(row, text), digest(row, other), doc_id))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    grown = {s: up([x[2] for x in sorted(trees[s])]) for s in names}
    top = up([grown[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for at, (*_, leaf, other, doc_id) in enumerate(sorted(trees[s])):
            path = beside(grown[s], at) + beside(top, place)
            end = other
            for left, right in path:
                end = h(left, end, right)
            out.append((doc_id, leaf, grown[s][-1][0], top[-1][0], h(*(a + b for a, b in path)), end, end == top[-1][0]))
    return out


def made(r, n):
    rows = [(i, r.choice([None, "", "a", "a", "a", "a", "b", "é", "\U0001f600", "c"]), r.choice(["en", None]), r.choice([None, i]), r.choice([None, "", "x\ny\n", "no line ends", "é\n\n"])) for i in r.sample(range(-50, 5000), n)]
    return rows + rows[:5] + [(None, "a", None, None, None), (None, "a", None, None, "t\n"), (None, None, None, None, None), (7000, "lone", "en", 1, "only\n"), (7001, "a", "en", 1, "long " * 30000)]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_plain_trees(spark, levels):
    """Blocks of 3, 9 and 2,187 leaves: trees of several blocks above each other give the same digests."""
    rows = made(random.Random(levels), 120)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("tree", F.lit("x")).withColumn("root", F.lit(1))
    found = merkle.manifest(docs.repartition(5), merkle.without_line_ends(), levels)
    proof = merkle.proof_digest(F.col("left"), F.col("right"))
    got = found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows), key=repr)


def test_query(spark, tmp_path):
    rows = made(random.Random(4), 60)
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_merkle(spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_versions_share_nodes():
    """A version of a tree of 3 ** 5 leaves has 6 nodes of its own; those before it stay as they are."""
    leaves = [h(str(k)) for k in range(3**5)]
    tree = merkle.Persistent(leaves)
    nodes, first = len(tree.digest), tree.digest[tree.root]
    roots = [tree.changed(tree.root, k, h("new", str(k))) for k in (0, 100, 242)]
    assert len(tree.digest) == nodes + 3 * 6 and tree.digest[tree.root] == first == up(leaves)[-1][0]
    for k, root in zip((0, 100, 242), roots, strict=True):
        assert tree.digest[root] == up([*leaves[:k], h("new", str(k)), *leaves[k + 1 :]])[-1][0]
    both = tree.changed(roots[0], 100, h("new", "100"))  # a version of a version
    assert tree.digest[both] == up([h("new", "0"), *leaves[1:100], h("new", "100"), *leaves[101:]])[-1][0]


def test_proofs_verify_in_columns(spark):
    docs = spark.createDataFrame(made(random.Random(9), 40), "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.manifest(docs)
    assert found.where("NOT verified OR changed_leaf IS NOT NULL").count() == 0
    assert found.where(merkle.fold(F.col("leaf"), F.col("left"), F.col("right")) != F.col("root")).count() == 0
    changed = merkle.manifest(docs, {"lang": F.lit("xx")})
    assert changed.where("verified OR changed_leaf IS NULL").count() == 0
    assert merkle.manifest(docs.where("false")).count() == 0
