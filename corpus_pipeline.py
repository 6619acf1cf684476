"""The corpus pipeline: documents without toxic ones, near duplicates and repeated passages, mixed and packed.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and is written as Parquet.

All stages take nulls in any column, empty and very long texts and rows that repeat, and give an empty table for an empty
one. Columns beyond COLUMNS, whatever their names, are left out by each of them. Null and empty texts aren't toxic, are near
duplicates of each other (one of them stays), hold no repeats, have no words to mix (they are taken as often as their source's
rate says) and are one piece of one token. Of rows that repeat in doc_id and text one stays after the second stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handbill.llm import mixing, packing, similar, substring, toxicity
from handbill.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger doesn't hold to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.filter_toxic(docs, labels).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that pairs of similarity 0.8 or more, by shingles of five words, link.

    Candidates come from SimHash fingerprints, as many as that similarity needs, dealt by vantage-point trees; the check is exact.
    """
    return similar.deduplicate(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that start earlier in the corpus; a document left empty goes."""
    cut = substring.remove_repeats(docs).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.emit(mixing.mix(docs), COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 1,024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tagging, fingerprints, index search and packing are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
