"""All queries by name, and the SQL that says what they return.

Inputs are event records, pages and search results that Spark derives from the driver's tables; the SQL derives the same.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from handbill.functions import datetimes, geometry, jsons, schema, text
from handbill.operators import blocks, counts, events, layout, pictures, records, steps
from handbill.sources import files, named, search, sinks
from handbill.sources.storage import fresh_folder, settings, settled
from handbill.streaming import clusters

TODAY = date(2026, 3, 15)
TIMES = ["7 pm", "5 - 8:30 pm", "19:00", "noon", "7:30 pm – 9 pm", "12 am", "doors 7pm", "25 - 7 pm"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.replace("{raw}", RAW)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records with noisy names, dates and times: forty in a run."""
    o, p, s = (table(spark, sf_dir, t) for t in ("orders", "part", "supplier"))
    k = F.col("o_orderkey")
    name = (
        F.when(k % 35 == 4, F.lit(None)).when(k % 5 == 0, F.col("p_name")).when(k % 5 == 1, F.upper("p_name")).when(k % 5 == 2, F.concat("p_name", F.lit("!")))
        .when(k % 5 == 3, F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("-")))).otherwise(F.concat(F.lit("the "), F.col("p_name")))
    )
    return (
        o.join(p, F.col("p_partkey") == k % 200)
        .join(s, F.col("s_suppkey") == F.col("o_custkey") % 10)
        .select(
            F.floor(k / 40).cast("bigint").alias("run_id"),
            k.alias("ordinal"),
            name.alias("event_name"),
            F.col("s_name").alias("venue"),
            F.when(k % 3 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
            F.element_at(F.array(*map(F.lit, TIMES)), (k % 8 + 1).cast("int")).alias("time"),
            F.when(k % 4 == 0, F.col("o_orderpriority")).alias("recurring"),
        )
    )


RAW = f"""raw AS (SELECT o_orderkey // 40 AS run_id, o_orderkey AS ordinal,
  CASE WHEN o_orderkey % 35 = 4 THEN NULL WHEN o_orderkey % 5 = 0 THEN p_name WHEN o_orderkey % 5 = 1 THEN upper(p_name)
       WHEN o_orderkey % 5 = 2 THEN p_name || '!' WHEN o_orderkey % 5 = 3 THEN '  ' || replace(p_name, ' ', '-') ELSE 'the ' || p_name END AS event_name,
  s_name AS venue, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
  {TIMES!r}[(o_orderkey % 8 + 1)::INT] AS time, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS recurring
  FROM orders JOIN part ON p_partkey = o_orderkey % 200 JOIN supplier ON s_suppkey = o_custkey % 10)"""
NORM = "trim(regexp_replace(lower(coalesce({}, '')), '[^a-z0-9]+', ' ', 'g'))"


@query(r"""WITH noisy AS (SELECT doc_id, chr(160) || replace(text, '. ', '.' || chr(13) || ' ' || chr(9)) || chr(10) || ' ' AS t FROM documents),
  lines AS (SELECT doc_id, list_transform(string_split(replace(replace(t, chr(160), ' '), chr(13), chr(10)), chr(10)), lambda x: trim(x, ' ' || chr(9))) AS l FROM noisy)
SELECT doc_id, array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) AS cleaned FROM lines""")
def clean_text(spark, sf_dir):
    noisy = F.concat(F.lit(" "), F.replace("text", F.lit(". "), F.lit(".\r \t")), F.lit("\n "))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(noisy).alias("cleaned"))


@query(f"WITH {{raw}} SELECT ordinal, {NORM.format('event_name')} AS norm FROM raw")
def norm_name(spark, sf_dir):
    return raw_events(spark, sf_dir).select("ordinal", text.norm_name(F.col("event_name")).alias("norm"))


@query("WITH s AS (SELECT event_id, 'out' || (event_id % 7) || '_' || event_id AS stem FROM events) SELECT event_id, try_cast(regexp_extract(stem, '(\\d+)$', 1) AS BIGINT) AS suffix, try_cast(regexp_replace(stem, '\\D', '', 'g') AS BIGINT) AS digits, 'root/targets/target' || event_id || '.json' AS target FROM s")
def path_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("stem", F.concat(F.lit("out"), (F.col("event_id") % 7).cast("string"), F.lit("_"), F.col("event_id").cast("string")))
    paths = text.sibling_paths(F.lit("root"), text.numeric_suffix(F.col("stem")))
    return rows.select("event_id", text.numeric_suffix(F.col("stem")).cast("bigint").alias("suffix"), text.digits(F.col("stem")).alias("digits"), paths["target"].alias("target"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, count(*)::BIGINT AS n, sum(greatest(0, least(1000, round_even(1000 * l_extendedprice / 60000.0, 0)))::BIGINT)::BIGINT AS x, sum(greatest(0, least(1000, round_even(1000 * (l_quantity - 5) / 37.0, 0)))::BIGINT)::BIGINT AS y FROM lineitem GROUP BY ALL")
def bbox_1000(spark, sf_dir):
    x, y = geometry.to_thousand(F.col("l_extendedprice"), F.lit(60000.0)), geometry.to_thousand(F.col("l_quantity") - 5, F.lit(37.0))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("x"), F.sum(y).alias("y"))


@query("SELECT l_orderkey, min(l_quantity)::BIGINT AS x1, min(l_partkey)::BIGINT AS y1, max(l_quantity)::BIGINT AS x2, max(l_partkey)::BIGINT AS y2 FROM lineitem GROUP BY l_orderkey")
def poly_bbox(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.array(F.col("l_quantity"), F.col("l_partkey").cast("double"))).alias("points"))
    box = geometry.box_of(F.col("points"))
    return points.withColumn("box", box).select("l_orderkey", *[F.get("box", F.lit(k)).cast("bigint").alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))])


def noisy_json() -> F.Column:
    k = F.col("event_id") % 6
    p = F.col("props")
    return F.when(k == 0, p).when(k == 1, F.concat(F.lit("```json "), p, F.lit(" ```"))).when(k == 2, F.concat(F.lit('{"events":['), p, F.lit("]}"))).when(k == 3, F.concat(F.lit("["), p, F.lit(","), p, F.lit("]"))).when(k == 4, F.concat(p, F.lit(" trailing"))).otherwise(F.lit("nonsense"))


NOISY = """noisy AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '```json ' || props || ' ```' WHEN 2 THEN '{"events":[' || props || ']}'
  WHEN 3 THEN '[' || props || ',' || props || ']' WHEN 4 THEN props || ' trailing' ELSE 'nonsense' END AS t FROM events)"""


@query(f"WITH {NOISY} SELECT event_id, json_valid(t) AS strict, CASE event_id % 6 WHEN 2 THEN 1 WHEN 3 THEN 2 END::BIGINT AS n_events, event_id % 6 IN (0, 1, 2, 4) AS is_object, CASE event_id % 6 WHEN 2 THEN 'object' WHEN 3 THEN 'array' WHEN 5 THEN NULL ELSE 'object' END AS any_kind FROM noisy")
def dirty_json(spark, sf_dir):
    rows = jsons.with_attempts(table(spark, sf_dir, "events").select("event_id", noisy_json().alias("t")), "t")
    return rows.select("event_id", F.col("whole").isNotNull().alias("strict"), F.size(jsons.events_in()).cast("bigint").alias("n_events"), jsons.object_of().isNotNull().alias("is_object"), jsons.kind(jsons.any_of()).alias("any_kind"))


@query("SELECT o_orderkey, coalesce(nullif(trim(CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE ' ' || o_orderpriority || ' ' END), ''), 'NOVALUE') AS value FROM orders")
def coerce_fields(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.lit(" \t")).otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.coerce_novalue(raw).alias("value"))


@query(r"WITH {raw} SELECT run_id, arg_min(y, ordinal)::BIGINT AS first_year FROM (SELECT run_id, ordinal, try_cast(regexp_extract(date, '\b(19\d{2}|20\d{2})\b', 1) AS INT) AS y FROM raw) WHERE y IS NOT NULL GROUP BY run_id")
def first_year_hint(spark, sf_dir):
    rows = raw_events(spark, sf_dir).withColumn("y", datetimes.year_hint(F.col("date"))).where("y IS NOT NULL")
    return rows.groupBy("run_id").agg(F.min_by("y", "ordinal").cast("bigint").alias("first_year"))


@query("""WITH {raw} SELECT ordinal, CASE ordinal % 8 WHEN 0 THEN '19:00' WHEN 1 THEN '17:00' WHEN 2 THEN '19:00' WHEN 3 THEN 'NOVALUE' WHEN 4 THEN '19:30' WHEN 5 THEN '00:00' WHEN 6 THEN '19:00' ELSE 'NOVALUE' END AS start_time,
  CASE ordinal % 8 WHEN 1 THEN '20:30' WHEN 4 THEN '21:00' ELSE 'NOVALUE' END AS end_time FROM raw""")
def normalize_time(spark, sf_dir):
    return datetimes.with_times(raw_events(spark, sf_dir).select("ordinal", "time")).drop("time")


@query("""WITH d AS (SELECT o_orderkey, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders),
  t AS (SELECT *, try_cast('2026-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE) AS this, try_cast('2027-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE) AS following FROM d)
SELECT o_orderkey, CASE WHEN this IS NULL THEN NULL WHEN this - DATE '2026-03-15' >= -30 THEN this ELSE following END::VARCHAR AS upcoming FROM t""")
def nearest_upcoming(spark, sf_dir):
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", datetimes.nearest_upcoming(F.month(d), F.dayofmonth(d), TODAY).cast("string").alias("upcoming"))


@query("""WITH {raw}, d AS (SELECT ordinal, ordinal % 4 AS k, date, CAST(date AS DATE) AS day FROM raw WHERE date IS NOT NULL),
  this AS (SELECT *, try_cast('2026-' || strftime(day, '%m-%d') AS DATE) AS y FROM d)
SELECT ordinal, CASE k WHEN 0 THEN strftime(day, '%b %d') WHEN 1 THEN date WHEN 2 THEN strftime(day, '%d %B %Y') ELSE 'tbd' END AS free,
  CASE WHEN k IN (1, 2) THEN date WHEN k = 3 OR y IS NULL THEN 'NOVALUE' WHEN y - DATE '2026-03-15' >= -30 THEN y::VARCHAR ELSE '2027' || substr(y::VARCHAR, 5) END AS start_date FROM this""")
def normalize_date(spark, sf_dir):
    """Dates as free text, each with its own year at most: ISO and plain ones never reach the parser."""
    k = F.col("ordinal") % 4
    day = F.to_date("date")
    free = F.when(k == 0, F.date_format(day, "MMM dd")).when(k == 1, F.col("date")).when(k == 2, F.date_format(day, "dd MMMM yyyy")).otherwise(F.lit("tbd"))
    rows = raw_events(spark, sf_dir).where("date IS NOT NULL").select(F.col("ordinal").alias("source"), F.lit(0).alias("pos"), free.alias("date"), "time", F.lit(None).cast("string").alias("event_name"), F.lit(None).cast("string").alias("venue"))
    return records.normalize_when(rows, TODAY).select(F.col("source").alias("ordinal"), F.col("date").alias("free"), "start_date")


@query(r"""WITH {raw}, e AS (SELECT ordinal, trim(coalesce(event_name, '')) AS n, trim(venue) AS v, coalesce(date, '') AS d, time AS t FROM raw),
  q AS (SELECT ordinal, list_filter([CASE WHEN n <> '' THEN n || ' ' || v ELSE v END, CASE WHEN n <> '' THEN n || ' tickets ' || v END, CASE WHEN n <> '' THEN n || ' reservation ' || v END,
    CASE WHEN n <> '' THEN n || ' hours admission ' || v END, CASE WHEN d <> '' THEN CASE WHEN n <> '' THEN n || ' ' || v ELSE v END || ' ' || d END, CASE WHEN n <> '' THEN n || ' ' || v ELSE v END || ' ' || t], lambda x: x IS NOT NULL) AS l FROM e)
SELECT ordinal, len(l)::BIGINT AS n_queries, array_to_string(list_transform(l, lambda x: regexp_replace(x, '\s+', ' ', 'g')), '|') AS queries FROM q""")
def build_queries(spark, sf_dir):
    made = text.with_queries(raw_events(spark, sf_dir), "event_name", "venue", "date", "time")
    return made.select("ordinal", F.size("queries").cast("bigint").alias("n_queries"), F.array_join("queries", "|").alias("queries"))


@query(r"""WITH {raw}, b AS (SELECT ordinal, trim(coalesce(event_name, '') || ' ' || venue) AS base, coalesce(event_name, '') <> '' AS named, event_name AS n, venue AS v, date AS d, time AS t FROM raw),
  q AS (SELECT ordinal, list_filter([base, CASE WHEN named THEN n || ' tickets ' || v END, CASE WHEN named THEN n || ' reservation ' || v END, CASE WHEN named THEN n || ' hours admission ' || v END, base || ' ' || d, base || ' ' || t], lambda x: x IS NOT NULL) AS l FROM b)
SELECT ordinal, i::BIGINT AS query_no, trim(regexp_replace(l[i], '\s+', ' ', 'g')) AS search FROM q, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)""")
def query_explode(spark, sf_dir):
    """A row for each search query of each event, numbered from 1."""
    made = text.with_queries(raw_events(spark, sf_dir), "event_name", "venue", "date", "time")
    rows = made.select("ordinal", F.posexplode_outer("queries").alias("query_no", "search")).where("query_no IS NOT NULL")  # a filter on empty lists would be pushed through all steps
    return rows.withColumn("query_no", (F.col("query_no") + 1).cast("bigint"))


ENDPOINT = "https://search.test/v1"
KEYED = """asked AS (SELECT DISTINCT lower(trim(event_name)) || '|' || venue AS search, min(ordinal) AS first FROM raw WHERE event_name IS NOT NULL GROUP BY ALL),
  keyed AS (SELECT *, sha256('{"endpoint": "ENDPOINT", "payload": {"num": 10, "q": "' || search || '"}}') AS cache_key FROM asked)""".replace("ENDPOINT", ENDPOINT)


def asked_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct search of the events' names and venues, with its request and key; `first` is the event that asks first."""
    named = raw_events(spark, sf_dir).where("event_name IS NOT NULL").withColumn("search", F.concat_ws("|", F.lower(F.trim("event_name")), "venue"))
    return search.requests(named.groupBy("search").agg(F.min("ordinal").alias("first")), ENDPOINT)


def recorded_search(payload: str) -> str:
    """A provider that answers from the request alone: three results, the last one without a link."""
    q = json.loads(payload)["q"]
    found = [{"title": q, "snippet": f"about {q}", "link": f"https://site{k}.test/{len(q)}" if k < 2 else ""} for k in range(3)]
    return json.dumps({"organic": found})


@query(f"WITH {{raw}}, {KEYED} SELECT cache_key, search, first % 2 = 0 AS hit FROM keyed")
def cache_lookup(spark, sf_dir):
    """Searches and whether the cache, which every second one has filled, knows them; nothing is fetched."""
    asked = asked_searches(spark, sf_dir)
    path = fresh_folder(spark, "cache")
    search.fetch(asked.where("first % 2 = 0"), recorded_search).write.parquet(path)
    return search.read_through(asked, path).select("cache_key", "search", F.col("raw").isNotNull().alias("hit"))


@query(f"WITH {{raw}}, {KEYED} SELECT cache_key, search AS first_title, 3::BIGINT AS n_results FROM keyed")
def cache_misses(spark, sf_dir):
    """Answers to all searches: half from the cache, the others fetched once and appended to it."""
    asked = asked_searches(spark, sf_dir)
    path = fresh_folder(spark, "cache")
    search.fetch(asked.where("first % 2 = 0"), recorded_search).write.parquet(path)
    found = F.try_variant_get(F.parse_json("raw"), "$.organic", "array<struct<title: string>>")
    return search.read_through(asked, path, recorded_search).select("cache_key", found[0]["title"].alias("first_title"), F.size(found).cast("bigint").alias("n_results"))


@query(f"WITH {{raw}}, {KEYED} SELECT cache_key, search AS first_title, 3::BIGINT AS n_results FROM keyed WHERE first % 5 = 0")
def cache_folder(spark, sf_dir):
    """Answers from a cache of one JSON file a key: half were there, the others are fetched once and kept as files."""
    asked = asked_searches(spark, sf_dir).where("first % 5 = 0")
    folder = fresh_folder(spark, "cache")
    before = search.fetch(asked.where("first % 2 = 0"), recorded_search)
    named.write_named(before.select(F.concat("cache_key", F.lit(".json")).alias("name"), F.col("raw").alias("body")), folder)
    found = F.try_variant_get(F.parse_json("raw"), "$.organic", "array<struct<title: string>>")
    answers = named.read_through_files(asked, folder, recorded_search)
    return answers.select("cache_key", found[0]["title"].alias("first_title"), F.size(found).cast("bigint").alias("n_results"))


@query("""WITH r AS (SELECT user_id, event_id % 3 AS query_no, event_id AS place, CASE WHEN event_id % 11 = 0 THEN '' ELSE 'u' || (event_id % 17) END AS url FROM events),
  f AS (SELECT user_id, url, min(struct_pack(q := query_no, p := place)) AS seen FROM r WHERE url <> '' GROUP BY ALL)
SELECT user_id, rank, url FROM (SELECT user_id, url, row_number() OVER (PARTITION BY user_id ORDER BY seen, url) AS rank FROM f) WHERE rank <= 3""")
def evidence_topk(spark, sf_dir):
    e = F.col("event_id")
    url = F.when(e % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), (e % 17).cast("string")))
    found = events.top_evidence(table(spark, sf_dir, "events").select("user_id", (e % 3).alias("query_no"), e.alias("place"), url.alias("url")), "user_id", 3)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query("WITH {raw}, v AS (UNPIVOT (SELECT run_id, ordinal, event_name, venue, date, time, recurring FROM raw) ON event_name, venue, date, time, recurring INTO NAME field VALUE value),"
       " c AS (SELECT run_id, field, value, count(*) AS n, min(ordinal) AS f FROM v WHERE value <> '' GROUP BY ALL),"
       " b AS (SELECT run_id, field, value, row_number() OVER (PARTITION BY run_id, field ORDER BY n DESC, length(value) DESC, f) AS r FROM c)"
       " SELECT run_id, (SELECT count(*) FROM raw x WHERE x.run_id = b.run_id)::BIGINT AS n_events, max(value) FILTER (field = 'event_name') AS event_name, max(value) FILTER (field = 'venue') AS venue, max(value) FILTER (field = 'date') AS date, max(value) FILTER (field = 'time') AS time, max(value) FILTER (field = 'recurring') AS recurring FROM b WHERE r = 1 GROUP BY run_id")
def mode_tiebreak(spark, sf_dir):
    return events.merge_clusters(raw_events(spark, sf_dir), ["run_id"])


EXACT = f"WITH {{raw}}, n AS (SELECT *, {NORM.format('event_name')} AS norm FROM raw WHERE nullif(trim(event_name), '') IS NOT NULL) SELECT run_id, min(ordinal) AS root, count(*)::BIGINT AS n_events FROM n GROUP BY run_id, norm"


@query(EXACT)
def exact_dedupe(spark, sf_dir):
    """Thresholds of one: clusters are equal normal names, so SQL can say what they are."""
    return events.dedupe(raw_events(spark, sf_dir), 1.0, 1.0).select("run_id", "root", "n_events")


@query(EXACT)
def stream_dedupe(spark, sf_dir):
    """Events that arrive in three batches, the query started anew from its checkpoint for each: clusters as exact_dedupe has them."""
    base = fresh_folder(spark, "events")
    found = raw_events(spark, sf_dir).where(text.coerce(F.col("event_name")).isNotNull())
    with settings(spark, spark__sql__streaming__stateStore__providerClass=clusters.STORE):
        for third in range(3):
            found.where(F.floor(F.col("ordinal") % 40 * 3 / 40) == third).write.mode("append").parquet(f"{base}/in")
            arriving = spark.readStream.schema(found.schema).parquet(f"{base}/in")
            made = clusters.cluster_stream(arriving, 1.0, 1.0).writeStream.option("checkpointLocation", f"{base}/checkpoint")
            made.format("parquet").option("path", f"{base}/out").trigger(availableNow=True).start().awaitTermination()
    return events.merge_clusters(spark.read.parquet(f"{base}/out"), ["run_id", "root"]).select("run_id", "root", "n_events")


@query()
def fuzzy_pairs(spark, sf_dir):
    return events.match_edges(raw_events(spark, sf_dir))


@query()
def fuzzy_dedupe(spark, sf_dir):
    return events.dedupe(raw_events(spark, sf_dir))


def record_json() -> F.Column:
    k = F.col("p_partkey")
    links = F.concat(F.lit('{"website":"'), F.col("p_brand"), F.lit('","other":[" a ","a",1,"b","c","d"]}'))
    return F.concat(F.lit('{"type":"'), F.element_at(F.array(*map(F.lit, ("event", "attraction", "concert"))), (k % 3 + 1).cast("int")), F.lit('","title":" '), F.col("p_name"), F.lit(' ","links":'), links, F.lit(',"event":{"start_date":"2026-04-04"}}'))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 1 THEN 'attraction' ELSE 'event' END AS type, p_name AS title, 'NOVALUE' AS venue, p_brand AS website, 'a,b,c' AS other, CASE p_partkey % 3 WHEN 1 THEN 'NOVALUE' ELSE '2026-04-04' END AS start_date,
  'missing keys: address, description, venue' AS fault FROM part""")
def ensure_schema(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("v", jsons.strict_json(record_json())).withColumn("r", schema.ensure_schema(F.col("v")))
    return rows.select("p_partkey", "r.type", "r.title", "r.venue", "r.links.website", F.array_join("r.links.other", ",").alias("other"), "r.event.start_date", schema.validate(F.col("v")).alias("fault"))


@query("""SELECT doc_id, list_filter(['annotation', 'target'], lambda x: (x = 'annotation' AND e.vec_id IS NULL) OR (x = 'target' AND l.doc_id IS NULL)).array_to_string(',') AS missing
FROM documents d LEFT JOIN (SELECT DISTINCT vec_id FROM embeddings) e ON e.vec_id = d.doc_id LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def missing_report(spark, sf_dir):
    """What keeps an image from being a training sample."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), F.lit("path").alias("path"))
    prompts = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), F.lit("[]").alias("prompt")).distinct()
    targets = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("idx"), F.parse_json(F.lit("[]")).alias("v")).dropDuplicates(["idx"])
    made = records.training_samples(docs, docs, prompts, targets)
    return made.select(F.col("idx").alias("doc_id"), F.array_join("missing", ",").alias("missing"))


def listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Images, annotations, canvases and targets by number: pages, some of them without one or the other, and some that have no image."""
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("idx")).distinct()
    return pages.where("idx % 11 <> 0").withColumn("path", F.concat(F.lit("out"), F.col("idx").cast("string"))), pages.where("idx % 3 <> 0"), pages.where("idx % 4 <> 1"), pages.where("idx % 5 <> 2")


STEPS = """pages AS (SELECT DISTINCT conv_id AS idx FROM conversations),
  sides AS (SELECT idx, i.idx IS NOT NULL AS image, a.idx IS NOT NULL AS annotation, c.idx IS NOT NULL AS canvas, t.idx IS NOT NULL AS target FROM (SELECT idx FROM pages WHERE idx % 11 <> 0) i
    FULL JOIN (SELECT idx FROM pages WHERE idx % 3 <> 0) a USING (idx) FULL JOIN (SELECT idx FROM pages WHERE idx % 4 <> 1) c USING (idx) FULL JOIN (SELECT idx FROM pages WHERE idx % 5 <> 2) t USING (idx)),
  steps AS (SELECT idx, CASE WHEN NOT image THEN 'orphan' WHEN NOT annotation THEN 'all' WHEN NOT canvas THEN 'render' WHEN NOT target THEN 'target' ELSE 'nothing' END AS step,
    image AND NOT annotation AS "read", image AND (NOT annotation OR NOT canvas) AS render, image AND NOT target AS aim FROM sides)"""


@query(f"WITH {STEPS} SELECT * FROM steps")
def image_steps(spark, sf_dir):
    """What each image still needs: to be read, to be drawn, a target."""
    return steps.image_steps(*listings(spark, sf_dir))


def recorded_layout(path: str) -> str:
    """A provider of a page's layout that answers from its path alone: one block; some pages can't be read."""
    number = int(path.removeprefix("out"))
    if number % 13 == 6:
        raise OSError("no such page")
    return json.dumps({"width": 100, "height": 50, "parsing_res_list": [{"block_content": f"page {number}", "block_bbox": [10, 10, 90, 40], "block_order": 1}]})


@query(f"""WITH {STEPS}, n AS (SELECT conv_id AS idx, count(*) FILTER (turn % 4 <> 1 AND trim(text) <> '')::BIGINT AS n FROM conversations GROUP BY conv_id),
  w AS (SELECT s.*, "read" AND idx % 13 = 6 AS lost, CASE WHEN "read" THEN 1 ELSE n END AS n FROM steps s JOIN n USING (idx) WHERE step <> 'orphan')
SELECT idx, step, "read" AND NOT lost AS has_annotation, render AND NOT lost AND n > 0 AS has_canvas,
  CASE WHEN aim AND NOT lost AND n = 0 THEN '{{"events":[]}}' WHEN aim AND NOT lost AND n % 5 <> 4 THEN '{{"events":[{{"event_name":"' || n || ' blocks"}}]}}' END AS target,
  CASE WHEN lost THEN 'OSError: no such page' WHEN aim AND n % 5 = 4 THEN 'ValueError: ' || n || ' blocks are too many' END AS error FROM w""")
def image_work(spark, sf_dir):
    """The steps taken, each on its share, with recorded providers."""
    images, annotations, canvases, targets = listings(spark, sf_dir)
    found = steps.take_steps(steps.image_steps(images, annotations, canvases, targets), images, annotation_files(spark, sf_dir).join(annotations, "idx"), recorded_layout, recorded_reading)
    return found.select("idx", "step", F.col("annotation").isNotNull().alias("has_annotation"), F.col("canvas").isNotNull().alias("has_canvas"), "target", "error")


@query("SELECT d.doc_id, d.n_chars FROM documents d ANTI JOIN labels l USING (doc_id)")
def skip_existing(spark, sf_dir):
    return files.without_existing(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT user_id, floor(epoch(ts) / 3600)::BIGINT AS bucket, arg_min(event_id, ts)::BIGINT AS first_event, count(*)::BIGINT AS n FROM (SELECT * FROM events ORDER BY event_id) GROUP BY ALL")
def stride_sample(spark, sf_dir):
    found = files.first_in_stride(table(spark, sf_dir, "events"), ["user_id"], F.col("ts").cast("timestamp"), "event_id", 3600)
    return found.withColumnRenamed("first", "first_event")


@query("SELECT p_partkey, (p_size * 40)::BIGINT AS width, (p_partkey % 2000 + 1)::BIGINT AS height FROM part")
def png_dims(spark, sf_dir):
    """Widths and heights from the first bytes of PNG files, whose headers are made from parts."""
    sides = [F.lpad(F.hex(c), 8, "0") for c in (F.col("p_size") * 40, F.col("p_partkey") % 2000 + 1)]
    content = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), *sides, F.lit("0802000000")))
    found = table(spark, sf_dir, "part").select("p_partkey", geometry.png_size(content).alias("size"))
    return found.select("p_partkey", *[F.col(f"size.{k}").cast("bigint").alias(k) for k in ("width", "height")])


@query("""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
  r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE turn % 3 <> 1)
SELECT conv_id, i::BIGINT AS place, c.turn::BIGINT AS t, r.turn::BIGINT AS b FROM c JOIN r USING (conv_id, i)""")
def zip_positional(spark, sf_dir):
    """Turns side by side with every turn but some, as far as both go."""
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("all"))
    pairs = files.zip_positional(F.col("all"), F.filter("all", lambda x: x % 3 != 1), ("t", "b"))
    rows = own.select("conv_id", F.posexplode(pairs).alias("place", "p"))
    return rows.select("conv_id", (F.col("place") + 1).cast("bigint").alias("place"), *[F.col(f"p.{k}").cast("bigint").alias(k) for k in "tb"])


@query("WITH v AS (SELECT p_partkey, (p_size * 100)::BIGINT AS total FROM part) SELECT p_partkey, sec::BIGINT AS sec, greatest(0, least(total - 1, round_even(sec * 29.97, 0)))::BIGINT AS frame FROM v, LATERAL (SELECT unnest(range(0, floor(total / 29.97)::BIGINT + 1, 2)) AS sec)")
def sample_plan(spark, sf_dir):
    videos = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 100).cast("bigint").alias("total"), F.lit(29.97).alias("fps"))
    return geometry.sample_plan(videos, 2.5).select("p_partkey", F.col("sec").cast("bigint").alias("sec"), "frame")


@query("SELECT page_id, 'data:image/png;base64,' || base64(encode(html)) AS url FROM pages")
def data_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", geometry.data_url(F.encode("html", "UTF-8")).alias("url"))


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as pages: a turn is an item, some without text, some without an order."""
    t = F.col("turn").cast("double")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("image"), F.col("turn").alias("pos"), F.when(F.col("turn") % 4 == 1, F.lit(" ")).otherwise(F.col("text")).alias("text"),
        (t * 10).alias("x1"), (t * 20).alias("y1"), (t * 10 + 300).alias("x2"), (t * 20 + 33).alias("y2"), F.when(F.col("turn") % 3 != 0, -F.col("turn")).alias("order"), F.lit(1920.0).alias("width"), F.lit(1080.0).alias("height"),
    )


BLOCKS = """kept AS (SELECT conv_id AS image, turn AS pos, CASE WHEN turn % 3 <> 0 THEN -turn END AS ord, turn FROM conversations WHERE turn % 4 <> 1 AND trim(text) <> ''),
  dense AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY pos) - 1 AS id FROM kept)
SELECT image, row_number() OVER (PARTITION BY image ORDER BY ord ASC NULLS LAST, {0}) AS place, {0}::BIGINT AS id,
  concat_ws(',', least(1000, round_even(1000 * turn * 10 / 1920.0, 0))::BIGINT, least(1000, round_even(1000 * turn * 20 / 1080.0, 0))::BIGINT, least(1000, round_even(1000 * (turn * 10 + 300) / 1920.0, 0))::BIGINT, least(1000, round_even(1000 * (turn * 20 + 33) / 1080.0, 0))::BIGINT) AS box FROM dense"""


@query("WITH " + BLOCKS.format("id"))
def block_build_dense(spark, sf_dir):
    return blocks.build_blocks(page_items(spark, sf_dir)).select("image", "place", "id", F.array_join("box", ",").alias("box"))


@query("WITH " + BLOCKS.format("pos"))
def block_build_raw(spark, sf_dir):
    return blocks.build_blocks(page_items(spark, sf_dir), dense=False).select("image", "place", "id", F.array_join("box", ",").alias("box"))


@query("WITH b AS (" + "WITH " + BLOCKS.format("id") + """), t AS (SELECT conv_id AS image, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS id, text, CASE WHEN turn % 3 <> 0 THEN -turn END AS ord
  FROM conversations WHERE turn % 4 <> 1 AND trim(text) <> '')
SELECT image, count(*)::BIGINT AS n_blocks, '[' || string_agg('{"id":"B' || id || '","text":' || to_json(list_aggregate(list_filter(list_transform(string_split(replace(replace(text, chr(160), ' '), chr(13), chr(10)), chr(10)), lambda x: trim(x, ' ' || chr(9))), lambda x: x <> ''), 'string_agg', chr(10)))
  || coalesce(',"order":' || ord, '') || ',"bbox_1000":[' || box || ']}', ',' ORDER BY place) || ']' AS prompt FROM b JOIN t USING (image, id) GROUP BY image""")
def prompt_blocks(spark, sf_dir):
    return blocks.prompt_blocks(blocks.build_blocks(page_items(spark, sf_dir)))


@query("WITH b AS (SELECT conv_id, turn, turn * 7 % 50 AS x, turn * 11 % 30 AS y FROM conversations) SELECT a.conv_id, a.turn, count(b.turn)::BIGINT AS n_overlaps FROM b a LEFT JOIN b ON a.conv_id = b.conv_id AND b.turn < a.turn AND a.x <= b.x + 9 AND b.x <= a.x + 9 AND a.y <= b.y + 9 AND b.y <= a.y + 9 GROUP BY ALL")
def badge_overlap(spark, sf_dir):
    """How many earlier badges of its page each badge meets."""
    x, y = F.col("turn") * 7 % 50, F.col("turn") * 11 % 30
    badges = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array(x, y, x + 9, y + 9).alias("box"))
    before = F.collect_list("box").over(Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    hits = F.filter("before", lambda b: geometry.overlap(F.col("box"), b))
    return badges.withColumn("before", before).select("conv_id", "turn", F.size(hits).cast("bigint").alias("n_overlaps"))


def prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs as the JSON files that a model leaves: events under prediction.events, with a stray text among them."""
    e = F.to_json(F.struct("event_name", "venue", "date", "time", "recurring"))
    own = raw_events(spark, sf_dir).groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", e.alias("e")))).alias("all"))
    body = F.concat(F.lit('{"prediction":{"events":["stray",'), F.array_join(F.transform("all", lambda x: x["e"]), ","), F.lit("]}}"))
    name = F.concat(F.lit("prediction"), F.col("run_id").cast("string"), F.lit(".json"))
    return own.select("run_id", name.alias("file_name"), body.alias("body")).withColumn("v", jsons.strict_json(F.col("body")))


@query("""WITH {raw} SELECT 'prediction' || run_id || '.json' AS source, row_number() OVER (PARTITION BY run_id ORDER BY ordinal) AS pos,
  nullif(trim(event_name), '') AS event_name, venue, date, time, recurring FROM raw""")
def prediction_events(spark, sf_dir):
    rows = files.prediction_events(prediction_files(spark, sf_dir))
    return rows.select("source", F.col("pos").cast("bigint").alias("pos"), "event_name", "venue", "date", "time", "recurring")


@query("""WITH {raw} SELECT 'enriched_' || run_id || '.json' AS file_name, string_agg(coalesce(trim(event_name), '-'), '|' ORDER BY ordinal) AS titles FROM raw GROUP BY run_id""")
def result_files(spark, sf_dir):
    """Names of result files and the titles in each, in order."""
    made = prediction_files(spark, sf_dir)
    kept = sinks.per_file(files.prediction_events(made), made, "enriched_", F.coalesce("event_name", F.lit("-")))
    return kept.select("file_name", F.array_join("items", "|").alias("titles"))


@query("""WITH {raw} SELECT 'enriched_' || run_id || '.json' AS file_name, count(*)::BIGINT AS n_items, arg_min(coalesce(trim(event_name), '-'), ordinal) AS first_title FROM raw GROUP BY run_id""")
def named_files(spark, sf_dir):
    """Result files written under their names, and what is read back from them."""
    made = prediction_files(spark, sf_dir)
    kept = sinks.per_file(files.prediction_events(made), made, "enriched_", F.struct(F.coalesce("event_name", F.lit("-")).alias("title"), "venue"))
    folder = fresh_folder(spark, "results")
    sinks.write_json(kept, folder, F.col("file_name"), F.col("items"))
    found = files.json_files(spark, folder, "enriched_*.json").withColumn("items", F.try_variant_get("v", "$", "array<struct<title: string>>"))
    return found.select("file_name", F.size("items").cast("bigint").alias("n_items"), F.col("items")[0]["title"].alias("first_title"))


@query(f"""WITH {{raw}}, n AS (SELECT *, nullif(trim(event_name), '') AS name, {NORM.format('event_name')} AS norm FROM raw), m AS (SELECT run_id, norm FROM n WHERE name IS NOT NULL GROUP BY ALL)
SELECT 'files' AS place, 'rows' AS what, count(DISTINCT run_id)::BIGINT AS n FROM n UNION ALL SELECT 'files', 'failed', 0 UNION ALL SELECT 'events', 'rows', count(*) FROM n UNION ALL SELECT 'events', 'nameless', count(*) FROM n WHERE name IS NULL
UNION ALL SELECT 'merged', 'rows', count(*) FROM m""")
def run_counts(spark, sf_dir):
    """Files, events and merged records of a run, counted by the run that writes the records."""
    seen = counts.Counts()
    made = seen.at("files", prediction_files(spark, sf_dir), failed=F.col("v").isNull())
    found = seen.at("events", files.prediction_events(made), nameless=F.col("event_name").isNull())
    run = F.regexp_extract("source", r"(\d+)", 1).cast("bigint")
    merged = seen.at("merged", events.dedupe(settled(files.numbered(found, run)), 1.0, 1.0))
    merged.write.parquet(fresh_folder(spark, "merged"))
    return seen.table(merged)


@query("""WITH {raw}, t AS (SELECT 'prediction' || run_id || '.json' AS source, row_number() OVER (PARTITION BY run_id ORDER BY ordinal) AS pos, ordinal,
  nullif(trim(event_name), '') AS event_name, venue, date, time, recurring, coalesce(date, 'NOVALUE') AS start_date, coalesce(date, 'NOVALUE') AS end_date FROM raw)
SELECT * EXCLUDE (ordinal), CASE ordinal % 8 WHEN 1 THEN '17:00' WHEN 3 THEN 'NOVALUE' WHEN 4 THEN '19:30' WHEN 5 THEN '00:00' WHEN 7 THEN 'NOVALUE' ELSE '19:00' END AS start_time,
  CASE ordinal % 8 WHEN 1 THEN '20:30' WHEN 4 THEN '21:00' ELSE 'NOVALUE' END AS end_time FROM t""")
def normalize_when(spark, sf_dir):
    """Dates and times of all events; a file's first year stands in for a missing one."""
    found = records.normalize_when(files.prediction_events(prediction_files(spark, sf_dir)).drop("ordinal"), TODAY)
    return found.withColumn("pos", F.col("pos").cast("bigint"))


def annotation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as the JSON that layout analysis leaves: boxes or polygons, an order or none."""
    t = F.col("turn").cast("double")
    x1, y1, x2, y2 = t * 10, t * 20, t * 10 + 300, t * 20 + 33
    odd = F.col("turn") % 2 == 1
    text_ = F.when(F.col("turn") % 4 == 1, F.lit(" ")).otherwise(F.col("text"))
    order = F.when(F.col("turn") % 3 != 0, -F.col("turn"))
    item = F.struct(text_.alias("block_content"), F.when(~odd, F.array(x1, y1, x2, y2)).alias("block_bbox"), F.when(odd, F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))).alias("block_poly"), order.alias("block_order"))
    body = F.to_json(item, {"ignoreNullFields": "false"})
    own = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("idx")).agg(F.array_sort(F.collect_list(F.struct("turn", body.alias("e")))).alias("all"))
    whole = F.concat(F.lit('{"width":1920,"height":1080,"parsing_res_list":['), F.array_join(F.transform("all", lambda x: x["e"]), ","), F.lit("]}"))
    return own.select("idx", jsons.strict_json(whole).alias("v"))


@query("WITH " + BLOCKS.format("id"))
def annotation_blocks(spark, sf_dir):
    made = blocks.build_blocks(files.annotation_items(annotation_files(spark, sf_dir)))
    return made.select("image", "place", "id", F.array_join("box", ",").alias("box"))


def page_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn").cast("double")
    where = [(t * 37 % 1500).alias("x1"), (t * 53 % 900).alias("y1"), (t * 37 % 1500 + 420).alias("x2"), (t * 53 % 900 + 160).alias("y2")]
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("image"), F.col("turn").alias("place"), F.col("turn").alias("id"), text.clean_text(F.col("text")).alias("text"), *where, F.lit(1920).alias("width"), F.lit(1080).alias("height"))


@query()
def badge_place(spark, sf_dir):
    return layout.place_badges(layout.badge_size(layout.clamp_boxes(page_boxes(spark, sf_dir))))


@query()
def canvas_svg(spark, sf_dir):
    return layout.canvas(page_boxes(spark, sf_dir))


@query("SELECT conv_id AS image, 1920::BIGINT AS width, 1080::BIGINT AS height FROM (SELECT DISTINCT conv_id FROM conversations)")
def canvas_png(spark, sf_dir):
    """Pages drawn as pictures; their sizes are read back from the files' first chunks."""
    found = pictures.pictures(page_boxes(spark, sf_dir)).withColumn("s", geometry.png_size(F.col("png")))
    return found.select("image", *[F.col(f"s.{k}").cast("bigint").alias(k) for k in ("width", "height")])


@query("""WITH {raw}, n AS (SELECT ordinal, row_number() OVER () AS i, event_name, venue FROM raw)
SELECT ordinal, CASE WHEN ordinal % 5 = 0 THEN 0 WHEN ordinal % 3 = 0 THEN 1 ELSE 2 END::BIGINT AS n_results, CASE WHEN ordinal % 5 <> 0 THEN venue END AS first_title FROM n""")
def search_evidence(spark, sf_dir):
    """Evidence read from raw answers: results without a link don't count, two are kept."""
    k = F.col("ordinal")
    links = F.when(k % 3 == 0, F.lit('"","http://b"')).otherwise(F.lit('"http://a","http://b"'))
    result = F.transform(F.split(F.translate(links, '"', ""), ","), lambda u: F.struct(F.concat(F.lit(" "), F.col("venue")).alias("title"), F.lit("s").alias("snippet"), u.alias("link")))
    raw = F.when(k % 5 == 0, F.lit("no json")).otherwise(F.to_json(F.struct(result.alias("organic"))))
    rows = raw_events(spark, sf_dir).withColumn("found", search.evidence(raw, 2))
    return rows.select("ordinal", F.size("found").cast("bigint").alias("n_results"), F.get("found", F.lit(0))["title"].alias("first_title"))


@query("""SELECT d.doc_id AS idx, CASE WHEN l.doc_id IS NULL OR l.toxic = 1 THEN 'target' ELSE '' END AS missing,
  CASE WHEN l.doc_id IS NOT NULL AND l.toxic <> 1 THEN '{"events":["' || coalesce(l.quality, -1) || '"]}' END AS target FROM documents d LEFT JOIN labels l USING (doc_id)""")
def training_samples(spark, sf_dir):
    """Chat samples of images, canvases, prompts and targets; bare lists and objects are targets, other values are none."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"))
    quality = F.concat(F.lit('["'), F.coalesce(F.col("quality").cast("string"), F.lit("-1")), F.lit('"]'))
    body = F.when(F.col("toxic") == 1, F.lit('"none"')).when(F.col("doc_id") % 2 == 0, quality).otherwise(F.concat(F.lit('{"events":'), quality, F.lit(',"more":1}')))
    targets = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("idx"), jsons.strict_json(body).alias("v"))
    paths = text.sibling_paths(F.lit("root"), F.col("idx"))
    made = records.training_samples(docs.withColumn("path", paths["image"]), docs.withColumn("path", paths["canvas"]), docs.withColumn("prompt", F.lit("[]")), targets)
    return made.select("idx", F.array_join("missing", ",").alias("missing"), F.get("messages", F.lit(1))["content"][0]["text"].alias("target"))


def recorded_merge(prompt: str) -> str:
    """A provider of final records that answers from the prompt alone: some in brackets no parser takes, which it mends when asked."""
    if prompt.startswith(records.REPAIR):
        return prompt[len(records.REPAIR) :].translate(str.maketrans("<>()", "{}[]"))
    event = json.loads(prompt)
    name = event["event_name"]
    if name.endswith("!"):
        raise RuntimeError("the model is gone")
    link = event["evidence"][0]["url"] if event.get("evidence") else None
    times = {k: event.get(k) for k in ("start_date", "start_time", "end_date", "end_time")}
    answer = json.dumps([{"type": "event", "title": name, "venue": event.get("venue"), "links": {"website": link}, "event": times, "score": 1}])
    return answer.translate(str.maketrans("{}[]", "<>()")) if name.startswith("the ") else answer


@query("""WITH {raw} SELECT ordinal, CASE WHEN event_name LIKE '%!' THEN NULL ELSE trim(event_name) END AS title, CASE WHEN event_name LIKE '%!' THEN NULL ELSE coalesce(date, 'NOVALUE') END AS start_date,
  CASE WHEN event_name LIKE '%!' THEN 'RuntimeError: the model is gone' END AS error FROM raw WHERE event_name IS NOT NULL""")
def replay_merge(spark, sf_dir):
    """Final records from a recorded model: answers that are no JSON are sent back once, failures stay with their row."""
    named = raw_events(spark, sf_dir).where("event_name IS NOT NULL")
    prompt = F.to_json(F.struct("event_name", "venue", F.col("date").alias("start_date")))
    made = records.merge_records(named.select("ordinal", prompt.alias("prompt")), recorded_merge)
    return made.select("ordinal", "record.title", "record.event.start_date", "error")


@query("""WITH v AS (SELECT p_partkey, p_partkey % 4 AS k FROM part) SELECT p_partkey, CASE k WHEN 0 THEN 'item 1: missing keys: address, description, links, type, venue' WHEN 1 THEN 'item 0: not an object'
  WHEN 2 THEN 'not a list' ELSE 'item 0: event is no object' END AS fault FROM v""")
def validate_array(spark, sf_dir):
    """The first fault of lists of records, by the item's number; of two faults in an item the one that counts first."""
    good = '{"type":"event","title":"%","address":1,"venue":null,"description":"","links":{"website":"","tickets":"","reservation":"","other":[]},"event":{"recurring_weekly":"","recurring_weekday":"","start_date":"","start_time":"","end_date":"","end_time":""}}'
    two_faults = good.replace('"other":[]', '"other":5')
    two_faults = two_faults[: two_faults.index('"event":{')] + '"event":"%"}'
    lists = [f'[{good},{{"title":"%","event":1}}]', '["%"]', good, f"[{two_faults}]"]
    body = F.replace(F.element_at(F.array(*map(F.lit, lists)), (F.col("p_partkey") % 4 + 1).cast("int")), F.lit("%"), F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", schema.validate_list(jsons.strict_json(body)).alias("fault"))


@query()
def event_pipeline(spark, sf_dir):
    """Predictions to final records: events of each run merged, dated, searched for through a cache, and put to a recorded model."""
    found = files.prediction_events(prediction_files(spark, sf_dir))
    run = F.regexp_extract("source", r"(\d+)", 1).cast("bigint")
    merged = settled(events.dedupe(settled(files.numbered(found, run)))).withColumnsRenamed({"run_id": "source", "root": "pos"})
    dated = settled(records.normalize_when(merged, TODAY))
    key = F.struct("source", "pos")
    asked = text.with_queries(dated, "event_name", "venue", "date", "time").select(key.alias("event"), F.posexplode_outer("queries").alias("query_no", "search")).where("query_no IS NOT NULL")
    answers = search.answers(asked, ENDPOINT, fresh_folder(spark, "cache"), recorded_search)
    evidence = search.first_urls(asked.join(answers, "search"), "event")
    prompts = dated.withColumn("event", key).join(evidence, "event", "left")
    prompt = F.to_json(F.struct("event_name", "venue", "start_date", "start_time", "end_date", "end_time", "evidence"))
    made = records.merge_records(prompts.select("source", "pos", prompt.alias("prompt")), recorded_merge)
    return made.select(F.col("source").alias("run_id"), F.col("pos").alias("root"), "record.title", "record.venue", F.col("record.links.website").alias("website"), "record.event.start_date", "record.event.start_time", "error")


def recorded_reading(prompt: str) -> str:
    """A provider of page events that answers from the prompt alone: the number of its blocks, with words around it."""
    n = prompt.count('"id":"B')
    if n % 5 == 4:
        raise ValueError(f"{n} blocks are too many")
    return f'Here you are: {{"events":[{{"event_name":"{n} blocks"}}]}} Done.'


@query("""WITH n AS (SELECT conv_id AS idx, count(*) FILTER (turn % 4 <> 1 AND trim(text) <> '')::BIGINT AS n FROM conversations GROUP BY conv_id)
SELECT idx, CASE WHEN n = 0 THEN 'missing files: annotation' WHEN idx % 7 = 3 THEN 'missing files: canvas' WHEN n % 5 = 4 THEN 'ValueError: ' || n || ' blocks are too many' END AS error,
  CASE WHEN n > 0 AND idx % 7 <> 3 AND n % 5 <> 4 THEN n || ' blocks' END AS first_event, CASE WHEN n > 0 AND idx % 7 <> 3 AND n % 5 <> 4 AND idx % 2 = 0 THEN '{"events":[]}' END AS target FROM n""")
def prediction_records(spark, sf_dir):
    """Records of pages put to a recorded model: predictions, and errors in their places."""
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("idx")).distinct().withColumn("path", F.lit("p"))
    prompts = blocks.prompt_blocks(blocks.build_blocks(page_items(spark, sf_dir))).withColumnRenamed("image", "idx").withColumn("path", F.lit("a"))
    targets = pages.where("idx % 2 = 0").select("idx", F.parse_json(F.lit('{"events":[]}')).alias("v"))
    none = pages.where("false").select("idx", F.col("path").alias("error"))
    made = records.prediction_records(pages, pages.where("idx % 7 <> 3"), prompts, targets, none, recorded_reading)
    first = F.get_json_object("record", "$.prediction[0].event_name")
    return made.select("idx", "error", first.alias("first_event"), F.get_json_object("record", "$.target").alias("target"))
