"""Counts that a run gathers while it writes."""

import pytest
from pyspark.sql import functions as F

from handbill.operators.counts import Counts


def test_counts_of_one_run(spark, tmp_path):
    seen = Counts()
    rows = seen.at("read", spark.range(100).withColumn("v", F.when(F.col("id") % 4 == 0, F.col("id"))), failed=F.col("v").isNull(), low=F.col("v") < 10)
    kept = seen.at("kept", rows.where("v IS NOT NULL"))
    kept.write.parquet(str(tmp_path / "out"))
    assert seen.taken() == {"read": {"rows": 100, "failed": 75, "low": 3}, "kept": {"rows": 25}}
    assert sorted(map(tuple, seen.table(rows).collect())) == [("kept", "rows", 25), ("read", "failed", 75), ("read", "low", 3), ("read", "rows", 100)]
    with pytest.raises(ValueError, match="already"):
        seen.at("read", rows)


def test_nothing_to_count(spark):
    seen = Counts()
    seen.at("read", spark.range(0)).collect()
    assert seen.taken() == {"read": {"rows": 0}}
