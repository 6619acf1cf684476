"""Connected components by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import materialise


def signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("a", "b"), 20))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b) that isn't its component's smallest, the root.

    Each step links nodes to the smallest of their neighbours: minima are summed up before the shuffle, and what
    is joined to them is a plain equi-join, in which a hub's edges meet unless adaptive execution splits its partition. Steps repeat
    until no edge changes; each is written to the shared folder.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, last = signature(edges), before
        if before == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
