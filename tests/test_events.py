"""Clusters against a plain greedy pass, and the golden example."""

import random
from difflib import SequenceMatcher

from handbill.operators import events

GOLDEN = [
    ("Jazz Night", "Blue Note", "2026-04-04", "8 PM", None), ("東京", None, None, None, None), ("Jaz Night", "Blue Note Club", "2026-04-04", "8 PM", "Every Friday"),
    ("Jazz Nights Live", None, "2026-04-04", "8:00 PM", None), (None, "Nowhere", None, None, None), ("Salsa Social", None, "2026-05-01", None, None), ("Salsa Night Social", None, "2026-05-02", None, None),
]
SCHEMA = "run_id long, ordinal long, event_name string, venue string, date string, time string, recurring string"


def test_golden(spark):
    rows = spark.createDataFrame([(0, i, *r) for i, r in enumerate(GOLDEN)], SCHEMA)
    found = [tuple(r)[1:] for r in events.dedupe(rows).select("run_id", "root", "n_events", *events.FIELDS).orderBy("root").collect()]
    assert found == [
        (0, 3, "Jazz Nights Live", "Blue Note Club", "2026-04-04", "8 PM", "Every Friday"), (1, 1, "東京", None, None, None, None),
        (5, 1, "Salsa Social", None, "2026-05-01", None, None), (6, 1, "Salsa Night Social", None, "2026-05-02", None, None),
    ]


def test_random_against_greedy(spark):
    r = random.Random(4)
    words = ["jazz", "jaz", "night", "nights", "live", "salsa", "social", "art"]
    made = [(0, i, " ".join(r.choices(words, k=r.randint(1, 3))), None, r.choice(["2026-01-01", "2026-01-02", None]), None, None) for i in range(60)]
    clusters: list[list] = []
    for row in made:
        for c in clusters:
            if any((s := SequenceMatcher(None, row[2], o[2]).ratio()) >= 0.84 or (row[4] and row[4] == o[4] and s >= 0.72) for o in c):
                c.append(row)
                break
        else:
            clusters.append([row])
    rows = spark.createDataFrame(made, SCHEMA)
    found = {x["root"]: x["n_events"] for x in events.dedupe(rows).collect()}
    assert found == {c[0][1]: len(c) for c in clusters}


def test_mode_ties(spark):
    rows = spark.createDataFrame([(0, i, v, None, None, None, None) for i, v in enumerate(["a", "a", "bb", "bb", "cc", "cc"])], SCHEMA)
    assert events.merge_clusters(rows, ["run_id"]).first()["event_name"] == "bb"
    assert events.dedupe(rows.where("false")).count() == 0


def test_evidence(spark):
    rows = spark.createDataFrame([(1, 0, 0, "u1"), (1, 0, 1, "u2"), (1, 1, 0, "u2"), (1, 1, 1, ""), (1, 1, 2, "u3")], "k int, query_no int, place int, url string")
    assert [r["url"] for r in events.top_evidence(rows, "k", 3).orderBy("rank").collect()] == ["u1", "u2", "u3"]
    assert [r["url"] for r in events.top_evidence(rows, "k", 0).collect()] == ["u1"]


def test_long_chains_and_the_graph_example(spark):
    """Chains of many links settle in few rounds; 3 joins {1}, 4 joins {2}, though 3 also matches 2."""
    edges = [(0, k, k - 1) for k in range(1, 200)] + [(1, 3, 1), (1, 3, 2), (1, 4, 2)]
    rows = [(0, k) for k in range(201)] + [(1, k) for k in range(1, 6)]
    found = events.roots(spark.createDataFrame(rows, "run_id long, ordinal long"), spark.createDataFrame(edges, "run_id long, a long, b long"))
    got = {(r["run_id"], r["ordinal"]): r["root"] for r in found.collect()}
    assert got == {**{(0, k): 0 for k in range(200)}, (0, 200): 200, (1, 1): 1, (1, 2): 2, (1, 3): 1, (1, 4): 2, (1, 5): 5}
