"""Sharding by balanced label propagation. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handbill.llm.common import materialise, numbered, ranks, text_or_empty

#: Cells that documents of one group are dealt to, for each shard: what moves is a cell, never a whole group.
CELLS_A_SHARD = 8


def unit(*cols: str | int) -> Column:
    """A number in [0, 1) from a hash."""
    h = F.xxhash64(*[F.lit(c) if isinstance(c, int) else F.col(c) for c in cols])
    return F.pmod(F.shiftright(h, 11), F.lit(2**53)) / F.lit(float(2**53))


def propagate(cells: DataFrame, rows: int, shards: int, rounds: int) -> DataFrame:
    """cells(h1, h2, micro, n, shard) after `rounds` rounds of label propagation.

    A cell's neighbours are the other cells of its group. In each round a cell asks for the shard in which
    most of its group's documents are, of those that have room (equal votes: the shard that a hash of the
    group puts first, so that no two cells swap places for ever); if more ask for a shard than it has room
    for, a hash decides who may move. The driver sees one number for each shard and round.
    """
    quota = rows // shards
    for turn in range(rounds):
        load = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = {s: max(0, quota - load.get(s, 0)) for s in range(shards)}
        is_open = F.array(*[F.lit(room[s] > 0) for s in range(shards)])
        votes = cells.groupBy("h1", "h2", "shard").agg(F.sum("n").alias("votes")).withColumn("tie", F.xxhash64("h1", "h2", "shard"))
        tally = votes.groupBy("h1", "h2").agg(F.collect_list(F.struct("votes", "tie", "shard")).alias("tally"))
        own = F.filter("tally", lambda x: x["shard"] == F.col("shard"))[0]
        best = F.array_max(F.filter("tally", lambda x: (x["shard"] == F.col("shard")) | F.element_at(is_open, x["shard"].cast("int") + 1)))
        # where the whole of its group's own shard is full, a cell may still stay: its own votes are in the running
        asked = (
            cells.join(tally, ["h1", "h2"])
            .withColumn("own", own)
            .withColumn("best", best)
            .withColumn("to", F.when(F.struct("best.votes", "best.tie") > F.struct("own.votes", "own.tie"), F.col("best.shard")))
            .select("h1", "h2", "micro", "n", "shard", "to")
        )
        asked = materialise(asked, f"asked{turn}")
        demand = {r["to"]: r["n"] for r in asked.where("to IS NOT NULL").groupBy("to").agg(F.sum("n").alias("n")).collect()}
        if not demand:
            return cells
        chance = F.element_at(F.array(*[F.lit(min(1.0, room[s] / demand[s]) if s in demand else 0.0) for s in range(shards)]), F.col("to").cast("int") + 1)
        moves = F.col("to").isNotNull() & (unit("h1", "h2", "micro", turn) < chance)
        cells = asked.withColumn("shard", F.when(moves, F.col("to")).otherwise(F.col("shard"))).drop("to")
    return cells


def place(rows: DataFrame, shards: int) -> DataFrame:
    """shard and slot for rows(..., shard or null), so that counts of shards are at most one apart.

    A shard keeps its documents up to its quota. The others, and those without a shard, fill what is left
    free in the order of their ranks.
    """
    placed = numbered(rows.withColumn("shard", F.coalesce("shard", F.lit(-1))), "shard", "placed")
    load = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(load.values())
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    keeps = [min(quota[s], load.get(s, 0)) for s in range(shards)]
    pool, free, pool_from, free_from = load.get(-1, 0), 0, [], []
    for s in range(shards):
        pool_from.append(pool - keeps[s])
        free_from.append(free)
        pool += load.get(s, 0) - keeps[s]
        free += quota[s] - keeps[s]

    def at(values: list[int], index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), index.cast("int") + 1)

    own = F.greatest("shard", F.lit(0))
    stays = (F.col("shard") >= 0) & (F.col("rank") < at(keeps, own))
    in_pool = F.when(F.col("shard") < 0, F.col("rank")).otherwise(at(pool_from, own) + F.col("rank"))
    fills = sum((F.col("in_pool") >= F.lit(x)).cast("int") for x in free_from[1:]) if shards > 1 else F.lit(0)
    return (
        ranks(placed, "shard")
        .withColumn("stays", stays)
        .withColumn("in_pool", in_pool)
        .withColumn("fills", fills)
        .withColumn("slot", F.when(F.col("stays"), F.col("rank")).otherwise(at(keeps, F.col("fills")) + F.col("in_pool") - at(free_from, F.col("fills"))))
        .withColumn("shard", F.when(F.col("stays"), F.col("shard")).otherwise(F.col("fills")).cast("int"))
        .drop("rank", "stays", "in_pool", "fills")
    )


def shard(docs: DataFrame, shards: int = 8, rounds: int = 4) -> DataFrame:
    """All docs in `shards` shards under the law `rows`: counts at most one apart, equal texts together.

    Documents are linked if their texts are equal. They are dealt by hash, then label propagation moves
    linked ones together under each shard's quota; a group larger than a shard fills shards one by
    one. Unlinked documents fill what is left. Returns doc_id, size, text_crc32, law, shard, slot
    (gapless in its shard), grown_shard (null under this law).

    Null texts count as empty (size 1, checksum 0) and are linked with them. Nulls and repeats in doc_id do no harm:
    every row gets a slot of its own. An empty table gives an empty table; other columns are not read.
    """
    text = text_or_empty()
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(7), text).alias("h2"),
    )
    micro = F.pmod(F.xxhash64("doc_id", "h1"), F.lit(shards * CELLS_A_SHARD)).cast("int")
    rows = materialise(slim.withColumn("micro", micro), "rows")
    counts = rows.groupBy("h1", "h2", "micro").agg(F.count(F.lit(1)).alias("n"))
    linked = counts.groupBy("h1", "h2").agg(F.sum("n").alias("all_n")).where("all_n > 1").select("h1", "h2")
    cells = materialise(counts.join(linked, ["h1", "h2"]).withColumn("shard", F.pmod("micro", F.lit(shards))), "cells")
    cells = propagate(cells, rows.count(), shards, rounds)
    moved = rows.join(cells.select("h1", "h2", "micro", "shard"), ["h1", "h2", "micro"], "left")
    return place(moved.select("doc_id", "size", "text_crc32", "shard"), shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
