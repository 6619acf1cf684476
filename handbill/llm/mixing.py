"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from handbill.llm.common import WORD, fresh, materialise, others

#: Of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Copies of a row that are listed at once.
CHUNK = 4_096


def coin(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) that only the seed and the parts decide (null as "null"): 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("null")) for c in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_md5(text: str = "text") -> Column:
    return F.md5(F.col(text).cast("binary"))


def copies(rate: Column, seed: str, doc_id: Column, source: Column, digest: Column, rank: Column) -> Column:
    """floor(rate) copies, and one more if the coin of this row falls under the rate's fraction."""
    return (F.floor(rate) + (coin(seed, doc_id, source, digest, rank) < rate - F.floor(rate)).cast("int")).cast("bigint")


def rated(sized: DataFrame, size: Column, **options) -> DataFrame:
    """sized(source, ...) with source_size, target and rate: target by source_size, 0 for a source without words."""
    targets = source_targets(sized.select("source", size.alias("size")), **options)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("mix_source")))
    return joined.select(*sized.columns, "source_size", "target", rate.alias("rate"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, most: int = 2) -> DataFrame:
    """One row for each source of sizes(source, size): mix_source, source_size, target.

    Targets share percent of all words by weight; what is over `most` times a source's size is reshared
    by weight until none is above. That ends at a water level: sources in the order of size by weight are
    full up to the first that the level doesn't fill. The table has a row for each source, never for each
    document.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    full_first = Window.orderBy((F.col("source_size") / F.col("w")).asc(), "place")
    sources = (
        sizes.groupBy("source")
        .agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("w", w)
    )
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    after = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        sources.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("full_size", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("open_w", F.sum("w").over(after))
        # the level were this source the first that is not full, as a fraction of whole numbers
        .withColumn("num", F.lit(percent) * F.col("all_size") - F.lit(100 * most) * F.col("full_size"))
        .withColumn("den", F.lit(100) * F.col("open_w"))
        .withColumn("open", F.lit(most) * F.col("source_size") * F.col("den") >= F.col("w") * F.col("num"))
    )
    chosen = F.min(F.when(F.col("open"), F.struct((F.col("source_size") / F.col("w")).alias("r"), "place", "num", "den"))).over(everything)
    share = F.when(
        F.col("at.num").isNull() | ((F.col("w") * F.col("at.num")) >= F.lit(most) * F.col("source_size") * F.col("at.den")),
        (F.lit(most) * F.col("source_size")).cast("double"),
    ).otherwise((F.col("w") * F.col("at.num")).cast("double") / F.col("at.den").cast("double"))
    return level.withColumn("at", chosen).select(F.col("source").alias("mix_source"), "source_size", share.alias("target"))


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """docs with size, source_size, target, rate and copies; equal rows come as one, with their copies summed.

    A row is emitted floor(rate) times, plus once more if its coin is under the rate's fraction. doc_id, source, the
    text's MD5 and a rank among equal rows decide a coin, so a source meets its target whatever its ids are, and reruns
    agree. Null texts have no words; null sources form one source, the last. An empty table gives an empty
    table; other columns pass through, but for those named like a new one.
    """
    kept = others(docs, "size", "source_size", "target", "rate", "copies")
    equal = fresh(docs, "equal_rows")
    grouped = docs.groupBy(*kept).agg(F.count(F.lit(1)).alias(equal)).select(F.struct(*kept).alias("own_row"), F.col(equal).alias("n"))
    source, digest = F.col("own_row.source"), text_md5("own_row.text")
    sized = grouped.select("own_row", "n", source.alias("source"), words("own_row.text").alias("size"))
    found = rated(sized, F.col("size") * F.col("n"), **options)
    each = F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: copies(F.col("rate"), seed, F.col("own_row.doc_id"), source, digest, i))
    taken = F.aggregate(each, F.lit(0).cast("bigint"), lambda n, x: n + x)
    return found.withColumn("copies", taken).select("own_row.*", "size", "source_size", "target", "rate", "copies")


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row of mix() as many times as its copies say, in those columns; null or no copies: not at all.

    Rows that repeat are so many copies of one row. Only numbers are listed to be exploded, CHUNK at a time, so no cell holds
    all copies of a text.
    """
    number = fresh(mixed, "copy_number")
    chunks = mixed.where("copies > 0").withColumn(number, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies").cast("bigint") - 1, F.lit(CHUNK).cast("bigint"))))
    each = F.sequence(F.col(number), F.least(F.col(number) + CHUNK, F.col("copies").cast("bigint")) - 1)
    return chunks.withColumn(number, F.explode(each)).select(*columns)


def words_taken(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row, by the coins of mix(); texts are read once and not shuffled.

    Null texts have no words and take none; rows that repeat give rows that repeat, each with a coin of its own; an
    empty table gives an empty table; other columns are not read.
    """
    rows = docs.select("doc_id", "source", words().alias("size"), text_md5().alias("digest"))
    sized = materialise(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "sizes")
    found = rated(sized, F.col("size") * F.col("n"), **options).withColumn("rank", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    taken = copies(F.col("rate"), seed, F.col("doc_id"), F.col("source"), F.col("digest"), F.col("rank")) * F.col("size")
    return found.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS digest, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         row_number() OVER (PARTITION BY doc_id, source, text) AS rank FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][((place - 1) % 3 + 1)::INT]::BIGINT AS w FROM sources),
levels AS (
  SELECT *, (150 * sum(source_size) OVER () - 200 * coalesce(sum(source_size) OVER (
             ORDER BY source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS num,
         (100 * sum(w) OVER (ORDER BY source_size / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS den
  FROM weighed),
level AS (SELECT num, den FROM levels WHERE 2 * source_size * den >= w * num ORDER BY source_size / w, place LIMIT 1),
targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN l.num IS NULL OR s.w * l.num >= 2 * s.source_size * l.den THEN (2 * s.source_size)::DOUBLE
              ELSE (s.w * l.num)::DOUBLE / l.den::DOUBLE END AS target
  FROM weighed s LEFT JOIN level l ON true),
rated AS (
  SELECT d.doc_id, d.source, d.digest, d.rank, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate)::BIGINT + (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(source, 'null')
          || ':' || coalesce(digest, 'null') || ':' || rank), 1, 13))::BIGINT
          / 4503599627370496.0::DOUBLE < rate - floor(rate))::BIGINT) * size)::BIGINT AS taken
FROM rated"""
