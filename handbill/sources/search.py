"""Web search as a table: a cache by key that is read first, and a provider for what it lacks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from handbill.functions.jsons import kind, strict_json
from handbill.functions.text import strip
from handbill.sources.storage import settled

FETCHED = "cache_key string, raw string"


def requests(queries: DataFrame, endpoint: str, gl: str = "", hl: str = "", num: int = 10) -> DataFrame:
    """queries(search, ...) with payload and cache_key.

    The key is the SHA-256 of the request as JSON with sorted keys, so that caches made elsewhere keep their keys.
    """

    @F.pandas_udf("payload string, cache_key string")
    def keyed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            bodies = [{"q": t} | ({"gl": gl} if gl else {}) | ({"hl": hl} if hl else {}) | ({"num": num} if num else {}) for t in texts]
            keys = [hashlib.sha256(json.dumps({"endpoint": endpoint, "payload": b}, sort_keys=True).encode()).hexdigest() for b in bodies]
            yield pd.DataFrame({"payload": [json.dumps(b, ensure_ascii=False) for b in bodies], "cache_key": keys})

    return queries.withColumn("r", keyed("search")).select("*", "r.payload", "r.cache_key").drop("r")


def fetch(missing: DataFrame, provider: Callable[[str], str]) -> DataFrame:
    """(cache_key, raw): the provider's answer to each payload of missing(payload, cache_key), called in the tasks."""

    def answered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"cache_key": rows["cache_key"], "raw": [provider(p) for p in rows["payload"]]})

    return missing.select("payload", "cache_key").mapInPandas(answered, FETCHED)


def cached(spark: SparkSession, path: str) -> DataFrame:
    """The cache at path; empty where there is none yet."""
    try:
        return spark.read.schema(FETCHED).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).selectExpr("CAST(NULL AS string) AS cache_key", "CAST(NULL AS string) AS raw")  # no task starts for it


def read_through(asked: DataFrame, path: str, provider: Callable[[str], str] | None = None) -> DataFrame:
    """asked(payload, cache_key, ...) with raw: from the cache, or fetched once for each key and appended to it.

    Without a provider what the cache lacks stays null.
    """
    spark = asked.sparkSession
    if provider is not None:
        missing = asked.select("payload", "cache_key").dropDuplicates(["cache_key"]).join(cached(spark, path), "cache_key", "left_anti")
        fetch(missing, provider).write.mode("append").parquet(path)
    known = cached(spark, path).groupBy("cache_key").agg(F.min("raw").alias("raw"))  # a retried append may repeat a key
    return asked.join(known, "cache_key", "left")


def evidence(raw: Column, k: int = 10) -> Column:
    """array<struct(title, snippet, url)>: the first k results with a link, at least one where k is below one."""
    found = F.coalesce(F.try_variant_get(strict_json(raw), "$.organic", "array<variant>"), F.array().cast("array<variant>"))

    def part(x: Column, name: str) -> Column:
        return strip(F.coalesce(F.try_variant_get(x, f"$.{name}", "string"), F.lit("")))

    objects = F.filter(found, lambda x: kind(x) == "object")
    plain = F.transform(objects, lambda x: F.struct(part(x, "title").alias("title"), part(x, "snippet").alias("snippet"), part(x, "link").alias("url")))
    return F.slice(F.filter(plain, lambda x: x["url"] != ""), 1, max(k, 1))


def event_evidence(results: DataFrame, key: str, k: int = 7) -> DataFrame:
    """(key, evidence): of results(key, query_no, raw) the first k urls over all queries, none twice, in order."""
    return first_urls(results.select(key, "query_no", evidence(F.col("raw"), k).alias("found")), key, k)


def first_urls(results: DataFrame, key: str, k: int = 7) -> DataFrame:
    """(key, evidence) of results(key, query_no, found), as event_evidence() has it; found is what evidence() reads from an answer.

    An event has at most six queries of k results each, so its list is short.
    """
    placed = F.transform("found", lambda e, i: F.struct(F.col("query_no").alias("query_no"), i.alias("place"), e.alias("e")))
    own = results.where(F.size("found") > 0).groupBy(key).agg(F.array_sort(F.flatten(F.collect_list(placed))).alias("all"))
    listed = own.select(key, F.transform("all", lambda x: x["e"]).alias("all")).withColumn("urls", F.transform("all", lambda e: e["url"]))
    first = F.filter("all", lambda e, i: F.array_position("urls", e["url"]) == i + 1)
    return listed.select(key, F.slice(first, 1, max(k, 1)).alias("evidence"))


def answers(searches: DataFrame, endpoint: str, path: str, provider: Callable[[str], str] | None = None, k: int = 7) -> DataFrame:
    """(search, found) of each distinct text of searches(search): the first k results of its answer, which is asked for, and read, once."""
    asked = settled(requests(searches.select("search").distinct(), endpoint))
    return read_through(asked, path, provider).select("search", evidence(F.col("raw"), k).alias("found"))
