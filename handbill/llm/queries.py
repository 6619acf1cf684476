"""The queries of this subpackage: opN_<name> for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from handbill.llm import ann, media, merkle, mixing, packing, quality, runs, secrets, sharding, simhash, substring, tokens, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.tag(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.collapse_runs(runs.planted(documents(spark, sf_dir))))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text")))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(documents(spark, sf_dir), merkle.without_line_ends())
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"), "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_sharding": op3_sharding,
    "op4_substring": op4_substring,
    "op5_packing": op5_packing,
    "op6_neighbours": op6_neighbours,
    "op7_media": op7_media,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_runs": op11_runs,
    "op12_secrets": op12_secrets,
    "op13_merkle": op13_merkle,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {"op9_mixing": mixing.SQL, "op13_merkle": merkle.SQL}
