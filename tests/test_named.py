"""Files under their names: committed whole or not at all; a cache folder that two runs share."""

import json
import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from handbill.sources import files, named, search, sinks


def listed(folder):
    return sorted(p.name for p in folder.rglob("*") if not p.name.endswith(".crc"))


def test_names_and_texts(spark, tmp_path):
    out = tmp_path / "out"
    rows = spark.createDataFrame([(f"enriched_{k}.json", "é\n\U0001f600" * k) for k in range(40)] + [("none.json", None)], "name string, body string").repartition(7)
    named.write_named(rows, str(out))
    assert listed(out) == sorted([*(f"enriched_{k}.json" for k in range(40)), "none.json"])
    assert (out / "enriched_3.json").read_text(encoding="utf-8") == "é\n\U0001f600" * 3 and (out / "none.json").read_bytes() == b""
    named.write_named(spark.createDataFrame([("enriched_3.json", "new")], "name string, body string"), f"file://{out}")
    assert (out / "enriched_3.json").read_text() == "new" and len(listed(out)) == 41


def test_json_is_read_back_whole(spark, tmp_path):
    """Indented JSON has many lines: a file is one row all the same."""
    rows = spark.createDataFrame([("a.json", "é"), ("b.json", "y")], "k string, t string")
    sinks.write_json(rows, str(tmp_path / "j"), F.col("k"), F.array(F.struct("t"), F.struct("t")))
    sinks.write_json(rows.where("k = 'a.json'"), str(tmp_path / "j"), F.col("k"), F.struct(F.lit("new").alias("t")))
    assert "\n" in (tmp_path / "j" / "b.json").read_text() and json.loads((tmp_path / "j" / "b.json").read_text(encoding="utf-8")) == [{"t": "y"}] * 2
    read = files.json_files(spark, str(tmp_path / "j")).select("file_name", F.to_json("v")).collect()
    assert sorted(map(tuple, read)) == [("a.json", '{"t":"new"}'), ("b.json", '[{"t":"y"},{"t":"y"}]')]


@pytest.mark.parametrize("bad", ["", "a/b", ".hidden", "ok3", None])
def test_a_failed_job_leaves_nothing(spark, tmp_path, bad):
    """One row in the last of several tasks fails, or has a name that another task has."""
    out = tmp_path / "out"
    out.mkdir()
    (out / "before").write_text("kept")
    rows = spark.createDataFrame([(f"ok{k}", "x") for k in range(20)], "name string, body string").repartition(4)
    rows = rows.unionByName(spark.createDataFrame([(bad, "y")], "name string, body string"))
    with pytest.raises(PySparkException):
        named.write_named(rows, str(out))
    assert listed(out) == ["before"]
    named.write_named(rows.where("name LIKE 'ok%' AND body = 'x'"), str(out))
    assert len(listed(out)) == 21


def test_cache_folder(spark, tmp_path):
    cache = tmp_path / "cache"
    asked = search.requests(spark.createDataFrame([("é a", 0), ("b", 1), ("b", 2), ("plain", 3)], "search string, query_no int"), "http://e")
    cache.mkdir()
    key = asked.where("query_no = 0").first()["cache_key"]
    (cache / f"{key}.json").write_text('{\n  "organic": [],\n  "made": "elsewhere"\n}', encoding="utf-8")
    log = tmp_path / "log"

    def provider(payload):
        q = json.loads(payload)["q"]
        with open(log, "a") as f:
            f.write(q + "\n")
        return "no json" if q == "plain" else json.dumps({"organic": [{"title": q, "link": "http://é"}]})

    assert {r["raw"] for r in named.read_through_files(asked, str(cache)).collect()} == {None, (cache / f"{key}.json").read_text()}
    found = {r["query_no"]: r["raw"] for r in named.read_through_files(asked, str(cache), provider).collect()}
    assert json.loads(found[0])["made"] == "elsewhere" and found[1] == found[2] and "é" in found[1] and "\n" in found[1] and found[3] is None
    named.read_through_files(asked.where("query_no < 3"), str(cache), provider).collect()
    assert sorted(log.read_text().split()) == ["b", "plain"]
    assert [p.name for p in cache.iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")] == []
    table = str(tmp_path / "table")
    for _ in range(2):
        named.compact(spark, str(cache), table)
    assert search.cached(spark, table).count() == 2
    assert search.read_through(asked, table).where("raw IS NULL").count() == 1


def test_two_runs_fetch_a_key_once(tmp_path):
    asked, answers = [], []

    def provider(payload):
        asked.append(payload)
        time.sleep(0.3)
        return '{"a": 1}'

    def run(k):
        answers.append(named.fetch_claimed(str(tmp_path), f"key{k % 3}", "p", provider, 10, 60))

    threads = [threading.Thread(target=run, args=(k,)) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(asked) == 3 and len(answers) == 12 and set(answers) == {'{\n  "a": 1\n}'}


def test_claims_of_lost_runs_and_failures(tmp_path):
    (tmp_path / ".k.claim").touch()
    assert named.fetch_claimed(str(tmp_path), "k", "p", lambda p: "{}", 0.1, 60) is None
    assert named.fetch_claimed(str(tmp_path), "k", "p", lambda p: "{}", 5, 0) == "{}"
    with pytest.raises(ZeroDivisionError):
        named.fetch_claimed(str(tmp_path), "other", "p", lambda p: str(1 // 0), 1, 60)
    assert named.fetch_claimed(str(tmp_path), "other", "p", lambda p: "[1]", 1, 60) == "[\n  1\n]"
