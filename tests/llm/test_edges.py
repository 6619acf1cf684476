"""Every operator and every stage of the pipeline: nulls, blanks, ties, repeats, empty tables, extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from handbill.llm import media, merkle, mixing, packing, quality, runs, secrets, sharding, similar, simhash, substring, tokens, toxicity

#: Names that operators use inside or add.
NAMES = ["kept_id", "kept_hash", "own_hash", "text_hash", "target", "source_size", "mix_source", "size", "equal_rows", "_home", "_tie", "home", "tie", "anchor", "start", "fp", "component_id", "mid", "rank", "rate", "copies", "d", "n", "kept", "N_WORDS", "score", "spans", "held_out", "y", "media", "error", "runs", "secrets", "whole_text", "tree", "pos", "block", "digest"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LONG = "word after word " * 3000


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, "no id", "en", None), (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "b"), (4, LONG, "en", "b"), (4, LONG, "en", "b"), (5, LONG + "end", "en", None)]
    rows += [(i, f"alike words in all of these texts but for the number {i // 3}", "en", "abc"[i % 3]) for i in range(10, 25)] + [(10, "alike words in all of these texts but for the number 3", "en", "b")]
    made = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return made.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in NAMES]).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(1, 25)] + [(1, None, None), (4, 1, 7), (None, 1, 1)], "doc_id long, quality int, toxic int")


def untouched(found, names):
    """Each row's extra columns are those that it came with."""
    for r in found:
        for n in names:
            assert r[n] == f"{n}:{'none' if r['doc_id'] is None else r['doc_id']}"


PER_ROW = {
    "near_duplicates": lambda d, l: simhash.near_duplicates(d),
    "similar": lambda d, l: similar.near_duplicates(d),
    "tag": toxicity.tag,
    "shard": lambda d, l: sharding.shard(d),
    "media": lambda d, l: media.media_columns(d),
    "quality": lambda d, l: quality.score_quality(d, l, epochs=1),
    "taken": lambda d, l: mixing.words_taken(d),
    "tokens": lambda d, l: tokens.token_counts(d),
    "pack": lambda d, l: packing.pack(d).where("piece = 0"),
    "repeats": lambda d, l: substring.remove_repeats(d),
    "runs": lambda d, l: runs.collapse_runs(d),
    "planted": lambda d, l: runs.planted(d),
    "secrets": lambda d, l: secrets.find_secrets(d),
    "manifest": lambda d, l: merkle.manifest(d, merkle.without_line_ends()),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_each(docs, labels, name):
    ids = sorted(str(r["doc_id"]) for r in docs.select("doc_id").collect())
    assert sorted(str(r["doc_id"]) for r in PER_ROW[name](docs, labels).collect()) == ids
    assert PER_ROW[name](docs.where("false"), labels).count() == 0
    assert PER_ROW[name](docs.where("doc_id IS NULL"), labels.where("false")).count() == 3


PASSING = {
    "deduplicate": (lambda d, l: simhash.deduplicate(d), set()),
    "similar": (lambda d, l: similar.deduplicate(d), set()),
    "repeats": (lambda d, l: substring.remove_repeats(d), {"kept", "N_WORDS"}),
    "toxic": (toxicity.filter_toxic, set()),
    "mix": (lambda d, l: mixing.mix(d), {"target", "source_size", "size", "rate", "copies"}),
    "runs": (lambda d, l: runs.collapse_runs(d), {"runs", "collapsed"}),
    "secrets": (lambda d, l: secrets.find_secrets(d), {"secrets"}),
    "stored": (lambda d, l: media.described(d.withColumn("media", F.lit(None).cast("binary"))), {"media", "error"}),
}


@pytest.mark.parametrize("name", PASSING)
def test_other_columns_pass(docs, labels, name):
    f, new = PASSING[name]
    found = f(docs, labels)
    assert set(docs.columns) - new <= set(found.columns)
    untouched(found.collect(), set(NAMES) - new)
    assert f(docs.where("false"), labels).count() == 0


def test_what_is_kept(docs, labels):
    kept = simhash.deduplicate(docs).collect()
    assert sum(r["text"] is None or not r["text"].strip() for r in kept) == 1
    assert sorted(r["doc_id"] for r in similar.deduplicate(docs).collect() if r["doc_id"] and r["doc_id"] >= 10) == [10, 12, 15, 18, 21, 24]
    mixed = mixing.mix(docs).select("doc_id", "text", "size", F.col("copies")).collect()
    assert len(mixed) == docs.distinct().count() and all(r["copies"] is not None for r in mixed)
    assert mixing.emit(mixing.mix(docs).limit(0), COLUMNS).count() == 0
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in mixing.words_taken(docs).collect())


def test_copies_are_not_gathered(spark):
    """Many equal rows are one row of many copies, which come out one by one."""
    rows = spark.range(9_000).select(F.lit(1).alias("doc_id"), F.lit("same words").alias("text"), F.lit("a").alias("source"), F.lit(0).alias("copy_number"))
    mixed = mixing.mix(rows)
    copies = mixed.first()["copies"]
    found = mixing.emit(mixed, ["doc_id", "text", "copy_number"])
    assert mixed.count() == 1 and copies > mixing.CHUNK and found.count() == copies and found.distinct().count() == 1


def test_repeats_do_not_reach_the_driver(docs, labels):
    many = docs.select("doc_id", "text").where("doc_id = 4").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("k")
    texts, y = quality.sample(many, labels, "quality", F.lit(True), 100)
    assert len(texts) == len(y) == 1


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, labels, name, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    found = stage(spark, docs, str(tmp_path))
    assert found.columns == COLUMNS or name == "packing"
    assert found.count() > 0 and stage(spark, docs.where("false"), str(tmp_path)).count() == 0
