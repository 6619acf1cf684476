"""Bounds and clusters of names against plain ones, batch and stream."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from handbill.operators import events, matching
from handbill.plans import registry
from handbill.sources.storage import fresh_folder, settings
from handbill.streaming import clusters

WORDS = ["jazz", "jaz", "night", "nights", "live", "salsa", "social", "art", "the", "open air", "x"]
SCHEMA = "run_id long, ordinal long, event_name string, venue string, date string, time string, recurring string"


def names(r, n):
    return list({" ".join(r.choices(WORDS, k=r.randint(1, 4))) for _ in range(n)}) + ["", "a" * 64, "a" * 65, "ab" * 40, "b" * 64, "a" * 63 + "b"]


def plain(rows, strong=0.84, weak=0.72):
    """Roots of one run, one event after the other."""
    found: list[list] = []
    for row in rows:
        for c in found:
            if any(row[2] and o[2] and ((s := SequenceMatcher(None, row[2], o[2]).ratio()) >= strong or (row[4] and row[4] == o[4] and s >= weak)) for o in c):
                c.append(row)
                break
        else:
            found.append([row])
    return {x[1]: c[0][1] for c in found for x in c}


def made(r, run, n, words=None):
    pool = words or names(r, 30)
    return [(run, i, r.choice(pool), "v", r.choice(["2026-01-01", "2026-01-02", "2026-01-03", None]), None, None) for i in range(n)]


def test_bounds_hold():
    own = names(random.Random(1), 200)
    n = matching.Names(own)
    a, b = (x.ravel() for x in np.meshgrid(range(len(own)), range(len(own))))
    true = np.array([matching.ratio(own[i], own[j]) if own[i] and own[j] else 0.0 for i, j in zip(a, b, strict=True)])
    assert (n.by_characters(a, b) >= true).all() and (n.by_subsequence(a, b) >= true).all()
    for least in (0.72, 0.84, 1.0):
        found = matching.ratios([own[i] for i in a], [own[j] for j in b], least)
        assert ((found >= least) == (true >= least)).all()


def test_few_pairs_reach_the_ratio(spark, monkeypatch):
    """At least ten times fewer than length bands leave, on names of the test bed."""
    rows = registry.raw_events(spark, "/root/testdata/sf0.001").select(events.norm_name(F.col("event_name")).alias("n")).distinct().collect()
    own = sorted(x["n"] for x in rows if x["n"])
    pairs = [(x, y) for x in own for y in own if 2 * min(len(x), len(y)) >= 0.72 * (len(x) + len(y))]
    asked = []
    monkeypatch.setattr(matching, "ratio", lambda x, y: asked.append((x, y)) or SequenceMatcher(None, x, y).ratio())
    found = matching.ratios([x for x, _ in pairs], [y for _, y in pairs], 0.84)
    assert 10 * len(asked) <= len(pairs) and sum(found >= 0.84) >= 0.8 * len(asked)


@pytest.mark.parametrize("together", [5_000, 0])
def test_clusters_against_greedy(spark, together):
    """Runs as a whole in a task, and by joins and steps."""
    r = random.Random(3)
    runs = [made(r, k, r.randint(1, 70)) for k in range(6)]
    rows = spark.createDataFrame([x for run in runs for x in run], SCHEMA).repartition(5)
    found = events.cluster(rows, together=together)
    assert found.columns == [*rows.columns, "root"]
    got = {(x["run_id"], x["ordinal"]): x["root"] for x in found.collect()}
    assert got == {(k, i): root for k, run in enumerate(runs) for i, root in plain(run).items()}


def test_edges_against_all_pairs(spark):
    """match_edges finds what a cross join with the plain ratio finds."""
    rows = made(random.Random(5), 0, 80)
    found = {(x["a"], x["b"]) for x in events.match_edges(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = set()
    for p in rows:
        for q in rows[: p[1]]:
            s = SequenceMatcher(None, p[2], q[2]).ratio() if p[2] and q[2] else 0
            if s >= 0.84 or (p[4] and p[4] == q[4] and s >= 0.72):
                want.add((p[1], q[1]))
    assert found == want


def test_one_shuffle(spark):
    rows = spark.createDataFrame(made(random.Random(6), 0, 40), SCHEMA)
    plan = events.cluster(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_long_run_in_pieces(monkeypatch):
    """Names of a run are held against each other in pieces; all on one date, so that the lower ratio counts."""
    r = random.Random(7)
    rows = [(*x[:4], "2026-01-01", None, None) for x in made(r, 0, 150, names(r, 80))]
    monkeypatch.setattr(matching, "TOGETHER", 100)
    fit = matching.FirstFit(0.84, 0.72)
    want = plain(rows)
    assert fit.add([x[1] for x in rows], [x[2] for x in rows], [x[4] for x in rows]) == [want[x[1]] for x in rows]


def test_stream_agrees_with_batch(spark):
    """Three batches, the query started from its checkpoint for each: the roots that all events at once have."""
    r = random.Random(8)
    runs = [made(r, k, 45) for k in range(4)]
    rows = spark.createDataFrame([x for run in runs for x in run], SCHEMA)
    base = fresh_folder(spark, "stream")
    with settings(spark, spark__sql__streaming__stateStore__providerClass=clusters.STORE):
        for k in range(3):
            rows.where(F.floor(F.col("ordinal") / 15) == k).write.mode("append").parquet(f"{base}/in")
            found = clusters.cluster_stream(spark.readStream.schema(rows.schema).parquet(f"{base}/in"))
            found.writeStream.option("checkpointLocation", f"{base}/c").format("parquet").option("path", f"{base}/out").trigger(availableNow=True).start().awaitTermination()
    got = {(x["run_id"], x["ordinal"]): x["root"] for x in spark.read.parquet(f"{base}/out").collect()}
    assert got == {(k, i): root for k, run in enumerate(runs) for i, root in plain(run).items()}
