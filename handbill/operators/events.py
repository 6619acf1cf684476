"""Event records: fuzzy clusters, merging by a tie-broken mode, evidence."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handbill.functions.text import coerce, norm_name
from handbill.operators.matching import FirstFit, ratios
from handbill.sources.storage import settled

FIELDS = ("event_name", "venue", "date", "time", "recurring")
# How alike names must be, and how alike if the dates are equal.
STRONG, WEAK = 0.84, 0.72
#: Events of a run that one task clusters; larger runs are matched by joins and clustered by steps over all their events.
TOGETHER = 5_000


def similarity(least: float):
    """An Arrow function of two names, the later first: their ratio, or 0 where bounds keep it below `least`."""

    @F.pandas_udf(T.DoubleType())
    def similar(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for later, earlier in pairs:
            yield pd.Series(ratios(later.tolist(), earlier.tolist(), least), dtype=float)

    return similar.asNondeterministic()  # so that a filter on it stays above what makes the pairs distinct


def similar_names(names: DataFrame, by: list[str], least: float) -> DataFrame:
    """(by, later, earlier, sim) of ordered pairs of names(by, name) that are equal in `by` and have a ratio of at least that.

    The ratio is at most 2 * min / (min + max) of the lengths, so only names of near lengths are joined: names fall
    into bands of lengths, and each is looked up in its own and the next on both sides. Of what is left, bounds by characters
    and by common subsequences leave few pairs whose ratio is worked out, once for each. The ratio depends on the order of the pair, so
    both orders are kept.
    """
    ratio = F.lit(least / (2 - least))
    band = F.floor(F.log(F.length("name")) / F.log(1 / ratio)).cast("int") if least < 1 else F.length("name")
    banded = names.where("name <> ''").distinct().withColumn("band", band)
    left = banded.select(*by, F.col("name").alias("later"), F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])).alias("band"))
    pairs = left.join(banded.withColumnRenamed("name", "earlier"), [*by, "band"])
    near = F.least(F.length("later"), F.length("earlier")) >= ratio * F.greatest(F.length("later"), F.length("earlier"))
    near_pairs = pairs.where(near).select(*by, "later", "earlier").distinct()
    once = near_pairs.select("later", "earlier").distinct().withColumn("sim", similarity(least)("later", "earlier"))
    return near_pairs.join(once.where(F.col("sim") >= least), ["later", "earlier"])


def match_edges(events: DataFrame, strong: float = STRONG, weak: float = WEAK) -> DataFrame:
    """(run_id, a, b): ordinals of each event and each earlier one of its run that it matches.

    Two match if their names are as alike as `strong`, or as `weak` with equal dates: two joins, of which the second only
    holds names of one date against each other.
    """
    rows = events.select("run_id", "ordinal", norm_name(F.col("event_name")).alias("name"), coerce(F.col("date")).alias("date"))

    def joined(by: list[str], least: float, below: float | None = None) -> DataFrame:
        own = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in by))
        alike = similar_names(own.select(*by, "name"), by, least)
        alike = alike if below is None else alike.where(F.col("sim") < below)
        later = own.select(*by, F.col("ordinal").alias("a"), F.col("name").alias("later"))
        earlier = own.select(*by, F.col("ordinal").alias("b"), F.col("name").alias("earlier"))
        return later.join(alike, [*by, "later"]).join(earlier, [*by, "earlier"]).where("b < a").select("run_id", "a", "b")

    edges = joined(["run_id"], strong)
    return edges.unionByName(joined(["run_id", "date"], weak, strong)) if weak < strong else edges


def roots(events: DataFrame, edges: DataFrame) -> DataFrame:
    """(run_id, ordinal, root): the cluster each event falls into when, in order, it joins the first cluster with a match.

    That cluster's first event is the least that can be reached along edges to earlier events. Only events that have edges
    take part. Each round passes minima along edges, then every event takes over what its own root has reached, so
    chains shorten by more than a link a round; rounds end when none changes.
    """
    edges = settled(edges)
    ends = edges.select("run_id", F.col("a").alias("ordinal")).union(edges.select("run_id", F.col("b").alias("ordinal"))).distinct()
    found = settled(ends.withColumn("root", F.col("ordinal")))
    while True:
        reached = edges.join(found.select("run_id", F.col("ordinal").alias("b"), "root"), ["run_id", "b"]).groupBy("run_id", F.col("a").alias("ordinal")).agg(F.min("root").alias("reached"))
        passed = settled(found.join(reached, ["run_id", "ordinal"], "left").select("run_id", "ordinal", F.col("root").alias("before"), F.least("root", "reached").alias("root")))
        ahead = passed.select("run_id", F.col("ordinal").alias("root"), F.col("root").alias("ahead"))
        moved = settled(passed.join(ahead, ["run_id", "root"]).select("run_id", "ordinal", F.col("ahead").alias("root"), (F.col("ahead") < F.col("before")).alias("changed")))
        found = moved.drop("changed")
        if moved.where("changed").isEmpty():
            return events.select("run_id", "ordinal").join(found, ["run_id", "ordinal"], "left").withColumn("root", F.coalesce("root", "ordinal"))


def normal(events: DataFrame) -> DataFrame:
    """events with compared_name and compared_date as they are compared: normal, blank where there is none."""
    return events.withColumn("compared_name", norm_name(F.col("event_name"))).withColumn("compared_date", F.coalesce(coerce(F.col("date")), F.lit("")))


def fitted(names: list[str], dates: list[str], clusters: FirstFit, ranks: list[int]) -> list[int]:
    """Row numbers of the roots of a run's events, which `ranks` names in order."""
    found = clusters.add(list(range(len(ranks))), [names[i] for i in ranks], [dates[i] for i in ranks])
    return [ranks[k] for k in found]


def cluster(events: DataFrame, strong: float = STRONG, weak: float = WEAK, together: int = TOGETHER) -> DataFrame:
    """events with root: the ordinal of the first event of the cluster that each falls into, in order of ordinals.

    Runs of up to `together` events are clustered in Arrow groups of about as many events, several runs each, all by one shuffle; matches of
    larger ones are found by joins, and their clusters by roots(). Both give the same clusters.
    """
    ordinal = events.schema["ordinal"].dataType
    schema = T.StructType([*events.schema.fields, T.StructField("root", ordinal)])

    def first_fit(runs: pa.Table) -> pa.Table:
        known: dict[tuple[str, str], float] = RATIOS.setdefault("known", {})
        if len(known) > 1 << 20:
            known.clear()
        places, names, dates = (runs[c].to_pylist() for c in ("ordinal", "compared_name", "compared_date"))
        own: dict[str, list[int]] = {}
        for i, run in enumerate(runs["run_id"].to_pylist()):
            own.setdefault(repr(run), []).append(i)
        at = [0] * runs.num_rows
        for run in own.values():
            ranks = sorted(run, key=(lambda i: tuple(places[i].values())) if isinstance(places[0], dict) else places.__getitem__)
            for i, root in zip(ranks, fitted(names, dates, FirstFit(strong, weak, known=known), ranks), strict=True):
                at[i] = root
        return runs.drop_columns(["compared_name", "compared_date"]).append_column("root", runs["ordinal"].take(pa.array(at)))

    sizes = settled(events.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")))
    small_events = sizes.where(F.col("n") <= together).agg(F.sum("n")).first()[0] or 0
    group = F.pmod(F.xxhash64("run_id"), F.lit(small_events // max(together, 1) + 1))
    large = sizes.where(F.col("n") > together).select("run_id")
    if large.isEmpty():
        return normal(events).groupBy(group).applyInArrow(first_fit, schema)
    small, rest = events.join(large, "run_id", "left_anti"), events.join(large, "run_id", "left_semi")
    found = roots(rest, match_edges(rest, strong, weak))
    return normal(small).groupBy(group).applyInArrow(first_fit, schema).unionByName(rest.join(found, ["run_id", "ordinal"]).select(*schema.names))


#: Ratios that a worker has worked out, by pair of names.
RATIOS: dict[str, dict[tuple[str, str], float]] = {}


def merge_clusters(events: DataFrame, key: list[str]) -> DataFrame:
    """One record for each key: of each field the value that occurs most often, then the longest, then the first."""
    parts = [F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS]
    event = F.struct(F.lit("").alias("field"), F.lit("").alias("value"))  # so that events are read once
    values = events.select(*key, "ordinal", F.inline(F.array(*parts, event))).where("value <> '' OR field = ''")
    counts = values.groupBy(*key, "field", "value").agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first"))
    n_events = F.sum(F.when(F.col("field") == "", F.col("n"))).alias("n_events")
    return counts.groupBy(*key).agg(n_events, *[F.max(F.when(F.col("field") == f, F.struct("n", F.length("value").alias("size"), (-F.col("first")).alias("early"), "value")))["value"].alias(f) for f in FIELDS])


def dedupe(events: DataFrame, strong: float = STRONG, weak: float = WEAK) -> DataFrame:
    """run_id, root, the five fields and n_events of each merged cluster that has a name."""
    named = events.where(coerce(F.col("event_name")).isNotNull())  # nameless ones match nothing, and merge to nothing
    return merge_clusters(cluster(named, strong, weak), ["run_id", "root"]).where("event_name IS NOT NULL")


def top_evidence(results: DataFrame, key: str, k: int) -> DataFrame:
    """Of results(key, query_no, place, url) the first k urls of each key, in the order of queries and places, none twice.

    Empty urls don't count. As many as one is kept for a k below one.
    """
    first = results.where("url <> ''").groupBy(key, "url").agg(F.min(F.struct("query_no", "place")).alias("at"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("at", "url"))
    return first.withColumn("rank", rank).where(F.col("rank") <= max(k, 1)).select(key, "rank", "url")
