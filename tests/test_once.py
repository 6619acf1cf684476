"""Work on events is done once: runs share a task's group, answers are parsed once a search, clusters are read once."""

import json

import pandas as pd
from pyspark.sql import functions as F

from handbill.operators import events
from handbill.sources import search


def test_runs_share_groups(spark):
    """Runs of a few events don't make a group each, and none sees another's events."""
    rows = [(run, k, name, f"2026-04-0{k + 1}", None, None, None) for run in range(30) for k, name in enumerate(("Jazz Night", "Jaz Night", "Salsa", "jazz night"))]
    made = spark.createDataFrame([*rows, (None, 0, "Jazz Night", None, None, None, None)], "run_id long, ordinal long, event_name string, date string, venue string, time string, recurring string")
    found = {(r.run_id, r.ordinal): r.root for r in events.cluster(made).collect()}
    assert found == {(None, 0): 0} | {(run, k): 2 if k == 2 else 0 for run in range(30) for k in range(4)}
    plan = events.cluster(made)._jdf.queryExecution().executedPlan().toString()
    assert "pmod(xxhash64(run_id" in plan


def test_clusters_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for x in batches:
            seen.add(len(x))
            yield x

    rows = spark.createDataFrame([(1, k, "a" if k else None, None, None, None, None) for k in range(7)], "run_id long, ordinal long, event_name string, venue string, date string, time string, recurring string")
    merged = events.merge_clusters(rows.mapInPandas(count, rows.schema), ["run_id"])
    assert merged.columns == ["run_id", "n_events", *events.FIELDS]
    assert [tuple(r) for r in merged.collect()] == [(1, 7, "a", None, None, None, None)] and seen.value == 7


def test_answers_once_a_search(spark, tmp_path):
    asked = spark.createDataFrame(pd.DataFrame([{"event": e, "query_no": n, "search": f"q{(e + n) % 3}"} for e in range(20) for n in range(3)]))
    sent = spark.sparkContext.accumulator(0)

    def provider(payload):
        sent.add(1)
        q = json.loads(payload)["q"]
        return json.dumps({"organic": [{"title": f" {q} ", "snippet": "s", "link": f"http://{q if k else 'same'}"} for k in range(2)]})

    answers = search.answers(asked, "https://s.test", f"file://{tmp_path}/cache", provider).persist()
    assert answers.count() == 3 and sent.value == 3
    found = {r.event: [(e.title, e.url) for e in r.evidence] for r in search.first_urls(asked.join(answers, "search"), "event").collect()}
    raw = search.read_through(search.requests(asked, "https://s.test"), f"file://{tmp_path}/cache")
    assert found == {r.event: [(e.title, e.url) for e in r.evidence] for r in search.event_evidence(raw, "event").collect()}
    assert found[1] == [("q1", "http://same"), ("q1", "http://q1"), ("q2", "http://q2"), ("q0", "http://q0")]
    assert search.first_urls(asked.join(answers, "search").where(F.lit(False)), "event").isEmpty()
