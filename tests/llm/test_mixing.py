import pytest

import corpus_pipeline


def test_rows_without_ids_meet_targets(spark):
    """Sources a and b hold rows without ids, c equal ones, d one repeated id: none is taken all or not at all."""
    rows = [(None, f"{s} word {i} and more", "en", s, 1) for s in "ab" for i in range(1500)]
    rows += [(None, "all of these are equal", "en", "c", 1)] * 1500
    rows += [(7, f"d word {i} and more", "en", "d", 1) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    found = corpus_pipeline.mix_sources(spark, docs, "")
    assert found.columns == corpus_pipeline.COLUMNS
    taken = {r["source"]: r["count"] for r in found.groupBy("source").count().collect()}
    # 9,000 shared 3 : 1 : 2 : 3, a and d full at 3,000, the rest 1 : 2
    assert taken["a"] == taken["d"] == 3000
    assert taken["b"] == pytest.approx(1000, abs=100) and taken["c"] == pytest.approx(2000, abs=100)


def test_coins_do_not_depend_on_layout(spark):
    rows = [(None, f"word {i % 40}", "en", "ab"[i % 2], 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    once, again = (sorted(r["text"] for r in corpus_pipeline.mix_sources(spark, docs.repartition(n), "").collect()) for n in (1, 7))
    assert once == again
