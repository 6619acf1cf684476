"""A Merkle manifest of a dataset, and persistent versions of its trees for changed rows."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import materialise, ranks

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, and levels of an aligned block: a task holds trees of FAN ** LEVELS leaves.
FAN, LEVELS = 3, 7


def joined(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class Persistent:
    """A tree whose nodes never change: a version is a root, and shares with others all nodes that are not copied for it."""

    def __init__(self, leaves: list[str], levels: int | None = None):
        """levels: how many to build, even over a single node; None: until one node is left."""
        self.digest, self.kids = list(leaves), [()] * len(leaves)
        level, self.levels = list(range(len(leaves))), 0
        while self.levels < levels if levels is not None else len(level) > 1:
            level = [self.node(tuple(level[i : i + FAN])) for i in range(0, len(level), FAN)]
            self.levels += 1
        (self.root,) = level

    def node(self, kids: tuple[int, ...]) -> int:
        self.digest.append(joined([self.digest[k] for k in kids]))
        self.kids.append(kids)
        return len(self.digest) - 1

    def path(self, root: int, leaf: int) -> list[tuple[int, int]]:
        """(node, which of its kids leads to the leaf), from the root down."""
        found, at = [], root
        for level in range(self.levels - 1, -1, -1):
            turn = leaf // FAN**level % FAN
            found.append((at, turn))
            at = self.kids[at][turn]
        return found

    def changed(self, root: int, leaf: int, digest: str) -> int:
        """The root of a version in which that leaf has another digest: only its ancestors are copied."""
        self.digest.append(digest)
        self.kids.append(())
        at = len(self.digest) - 1
        for node, turn in reversed(self.path(root, leaf)):
            kids = self.kids[node]
            at = self.node((*kids[:turn], at, *kids[turn + 1 :]))
        return at

    def siblings(self, root: int, leaf: int) -> tuple[list[str], list[str]]:
        """From the leaf's level up: digests before and after the node that leads to it, concatenated."""
        left, right = [], []
        for node, turn in reversed(self.path(root, leaf)):
            own = [self.digest[k] for k in self.kids[node]]
            left.append("".join(own[:turn]))
            right.append("".join(own[turn + 1 :]))
        return left, right


def field(c: Column) -> Column:
    """A value so that concatenations can't be mistaken: its length in bytes, a colon, itself; - for null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(digest: Column, left: Column, right: Column) -> Column:
    """The root that a digest and its siblings, level by level, lead to."""
    return F.aggregate(F.arrays_zip(left.alias("left"), right.alias("right")), digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def block_tree(pos: int, digests: list[str], levels: int) -> Persistent:
    """An aligned block's tree: every block but the first is one of many, so it has all levels."""
    return Persistent(digests, levels if pos else None)


def in_order(block: pa.Table) -> pa.Table:
    return block.sort_by("pos")


def blocked(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN**levels}"))


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, pos, digest) of the roots of the aligned blocks of nodes(tree, pos, digest): the nodes that many levels above."""

    def root(key: tuple, block: pa.Table) -> pa.Table:
        tree = block_tree(key[1].as_py(), in_order(block)["digest"].to_pylist(), levels)
        return pa.table({"tree": [key[0].as_py()], "pos": pa.array([key[1].as_py()], pa.int64()), "digest": [tree.digest[tree.root]]})

    rows = blocked(nodes.select("tree", "pos", "digest"), levels)
    return materialise(rows.groupBy("tree", "block").applyInArrow(root, "tree string, pos bigint, digest string"), "blocks")


def paths(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, pos, left, right, root) of nodes(tree, pos, digest): the siblings on the way up from each, and where it ends.

    Trees are worked on in aligned blocks; block roots are the leaves of a tree with so many levels less, and so on.
    """
    if not nodes.agg(F.max("pos")).first()[0]:
        none = F.array().cast("array<string>")
        return nodes.select("tree", "pos", none.alias("left"), none.alias("right"), F.col("digest").alias("root"))

    def found(key: tuple, block: pa.Table, above: pa.Table) -> pa.Table:
        block, up = in_order(block), above.to_pylist()[0]
        tree = block_tree(key[1].as_py(), block["digest"].to_pylist(), levels)
        sides = [tree.siblings(tree.root, i) for i in range(block.num_rows)]
        return pa.table({
            "tree": block["tree"], "pos": block["pos"], "left": pa.array([s[0] + up["left"] for s in sides], pa.list_(pa.string())),
            "right": pa.array([s[1] + up["right"] for s in sides], pa.list_(pa.string())), "root": pa.array([up["root"]] * len(sides), pa.string()),
        })

    above = paths(block_roots(nodes, levels), levels)
    schema = "tree string, pos bigint, left array<string>, right array<string>, root string"
    return materialise(blocked(nodes, levels).groupBy("tree", "block").cogroup(above.groupBy("tree", "pos")).applyInArrow(found, schema), "paths")


def ordered(rows: DataFrame, *by: Column) -> DataFrame:
    """rows(tree, ...) with pos, gapless from 0 within each tree in that order; rows that are equal in it spread over tasks."""
    spread = [*by, F.monotonically_increasing_id()]
    placed = rows.repartitionByRange(*spread).sortWithinPartitions(*by).withColumn("mid", F.monotonically_increasing_id())
    return ranks(materialise(placed, "placed"), "tree").withColumnRenamed("rank", "pos")


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, left, right, changed_leaf, folded_root, verified) of every row of docs.

    A leaf is the digest of a row's COLUMNS. A source's leaves stand in the order of doc_id (null first, rows of one doc_id by
    their leaves); every FAN consecutive nodes become one until one is left, the subroot; subroots in the order of
    sources (null first, then by bytes) become the root likewise. left and right are the digests beside the way from
    leaf to root, level by level.

    `changed` gives columns new values, as tampering does. Each row that differs by it makes a version of its block's tree,
    which shares all nodes but the leaf's ancestors, and goes on up the siblings that its block has in the trees
    above. folded_root is that version's root, verified says whether it still is the root; where nothing differs the
    version is the tree itself. changed_leaf is null where nothing differs.

    Only digests are shuffled. A task holds a block of FAN ** levels leaves, whatever the size of its source. Rows that repeat are leaves
    that repeat. An empty table gives an empty table; other columns are not read.
    """
    values = {c: F.col(c) for c in COLUMNS}
    rows = docs.select(*COLUMNS)
    leaf, other = leaf_digest(list(values.values())), leaf_digest(list((values | (changed or {})).values()))
    digests = rows.select("doc_id", "source", leaf.alias("digest"), (other if changed else F.lit(None).cast("string")).alias("other"))
    digests = digests.select("doc_id", "source", "digest", F.when(F.col("other") != F.col("digest"), F.col("other")).alias("other"))
    digests = materialise(digests.withColumn("tree", field(F.col("source"))), "digests")
    leaves = materialise(ordered(digests, F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("digest")), "leaves")

    own = paths(block_roots(leaves, levels), levels)
    subroots = own.where("pos = 0").select("tree", F.col("root").alias("digest"))
    named = digests.select("tree", F.col("source").cast("string").alias("source")).distinct().join(subroots, "tree")
    placed = ordered(named.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "source", "digest"), F.col("source").asc_nulls_first())
    placed = materialise(placed, "sources")
    whole = placed.select("pos", F.col("name").alias("tree")).join(paths(placed, levels).select("pos", F.col("left").alias("l"), F.col("right").alias("r"), F.col("root").alias("whole")), "pos").drop("pos")
    above = own.join(whole, "tree").select("tree", "pos", F.concat("left", "l").alias("left"), F.concat("right", "r").alias("right"), F.col("root").alias("subroot"), F.col("whole").alias("root"))

    def versions(key: tuple, block: pa.Table, above: pa.Table) -> pa.Table:
        block, up = in_order(block), above.to_pylist()[0]
        tree = block_tree(key[1].as_py(), block["digest"].to_pylist(), levels)
        beyond = list(zip(up["left"], up["right"], strict=True))

        def to_root(digest: str) -> str:
            for left, right in beyond:
                digest = joined([left, digest, right])
            return digest

        same, left, right, ends = to_root(tree.digest[tree.root]), [], [], []
        for i, other in enumerate(block["other"].to_pylist()):
            before, after = tree.siblings(tree.root, i)
            left.append(before + up["left"])
            right.append(after + up["right"])
            ends.append(same if other is None else to_root(tree.digest[tree.changed(tree.root, i, other)]))
        n, strings = block.num_rows, pa.list_(pa.string())
        return pa.table({
            "doc_id": block["doc_id"], "leaf": block["digest"], "subroot": pa.array([up["subroot"]] * n, pa.string()), "root": pa.array([up["root"]] * n, pa.string()),
            "left": pa.array(left, strings), "right": pa.array(right, strings), "changed_leaf": block["other"],
            "folded_root": pa.array(ends, pa.string()), "verified": pa.array([x == up["root"] for x in ends]),
        })

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, left array<string>, right array<string>, changed_leaf string, folded_root string, verified boolean"
    parts = blocked(leaves.select("tree", "pos", "doc_id", "digest", "other"), levels)
    return parts.groupBy("tree", "block").cogroup(above.groupBy("tree", "pos")).applyInArrow(versions, schema)


def proof_digest(left: Column, right: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda x, y: F.concat(x, y)), ""), 256)


def without_line_ends() -> dict[str, Column]:
    """Texts of every second row, by the CRC-32 of its doc_id, lose their line feeds; a row without doc_id stays."""
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(picked, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


SQL = r"""
WITH RECURSIVE
fielded AS (
  SELECT doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, 8 * len(doc_id::VARCHAR)), lambda i: CASE WHEN i % 8 = 0 THEN ascii((doc_id::VARCHAR)[i // 8 + 1])::BIGINT ELSE 0 END)),
      lambda c, x: xor(xor(c, x) >> 1, 3988292384::BIGINT * (xor(c, x) & 1))) AS crc
  FROM documents),
leaves AS MATERIALIZED (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS other
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t FROM fielded)),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER () AS id FROM leaves),
nodes AS (
  SELECT source, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n),
tops AS MATERIALIZED (
  SELECT source, h AS subroot, level AS depth, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM tops
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 3, n),
root AS (SELECT h AS root FROM upper_nodes WHERE n = 1),
beside AS MATERIALIZED (
  SELECT p.id, s.level, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < p.pos // (3 ** s.level)::BIGINT), '') AS l,
    coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > p.pos // (3 ** s.level)::BIGINT), '') AS r
  FROM placed p JOIN nodes s ON p.source IS NOT DISTINCT FROM s.source AND s.n > 1 AND s.pos // 3 = p.pos // (3 ** (s.level + 1))::BIGINT GROUP BY p.id, s.level
  UNION ALL
  SELECT p.id, t.depth + s.level, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < t.pos // (3 ** s.level)::BIGINT), ''),
    coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > t.pos // (3 ** s.level)::BIGINT), '')
  FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source JOIN upper_nodes s ON s.n > 1 AND s.pos // 3 = t.pos // (3 ** (s.level + 1))::BIGINT GROUP BY p.id, t.depth, s.level),
folded AS (
  SELECT id, 0 AS level, other AS h FROM placed
  UNION ALL
  SELECT f.id, f.level + 1, sha256(b.l || f.h || b.r) FROM folded f JOIN beside b ON b.id = f.id AND b.level = f.level),
ends AS (SELECT id, arg_max(h, level) AS folded_root FROM folded GROUP BY id),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM beside GROUP BY id)
SELECT p.doc_id, p.leaf, t.subroot, r.root, coalesce(q.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.root AS verified
FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source CROSS JOIN root r JOIN ends e USING (id) LEFT JOIN proofs q USING (id)"""
