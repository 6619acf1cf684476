"""The fixed schema of final records: coercion and validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from handbill.functions.jsons import kind
from handbill.functions.text import NOVALUE, bound, coerce, coerce_novalue

# The keys of a final record.
TOP = ("type", "title", "address", "venue", "description", "links", "event")
LINKS = ("website", "tickets", "reservation", "other")
EVENT = ("recurring_weekly", "recurring_weekday", "start_date", "start_time", "end_date", "end_time")
TYPES = ("event", "attraction")


def plain_text(v: Column) -> Column:
    """A scalar as Python writes it (True, 5, 2.5), lists and objects as JSON; strings as they are; null for null."""
    def written(x: Column) -> Column:
        plain = F.try_variant_get(x, "$", "string")
        return F.when(kind(x) == "void", F.lit(None).cast("string")).when(kind(x) == "boolean", F.initcap(plain)).otherwise(F.coalesce(plain, F.to_json(x)))

    return bound(v, written)


def text_at(v: Column, path: str) -> Column:
    """A member as text or NOVALUE: strings stripped, other values as plain_text() writes them."""
    def novalue(x: Column) -> Column:
        string = F.startswith(F.to_json(x), F.lit('"'))  # kind(x) == "string", without its names
        return F.when(x.isNull(), F.lit(NOVALUE)).when(string, coerce_novalue(F.try_variant_get(x, "$", "string"))).otherwise(F.coalesce(plain_text(x), F.lit(NOVALUE)))

    return bound(F.try_variant_get(v, path, "variant"), novalue)


def extra(v: Column, path: str, known: tuple[str, ...]) -> Column:
    """Members of an object that the schema doesn't name, as JSON texts by key; none where it is no object."""
    members = F.try_variant_get(v, path, "map<string,variant>")
    kept = F.map_filter(members, lambda k, x: ~k.isin(*known))
    return F.coalesce(F.transform_values(kept, lambda k, x: F.to_json(x)), F.create_map().cast("map<string,string>"))


def other_links(v: Column) -> Column:
    """At most three distinct other links: strings only, stripped, none blank."""
    listed = F.coalesce(F.try_variant_get(v, "$.links.other", "array<variant>"), F.array().cast("array<variant>"))
    texts = F.transform(listed, lambda x: F.when(kind(x) == "string", coerce(F.try_variant_get(x, "$", "string"))))
    return F.slice(F.array_distinct(F.array_compact(texts)), 1, 3)


def ensure_schema(v: Column) -> Column:
    """A record of the fixed schema from a variant, null or no object included.

    What is missing, null or blank is NOVALUE, an unknown type is an event, attractions have no times; what the schema
    doesn't name is kept under `extra`, at the top, in links and in event.
    """
    def record(x: Column) -> Column:
        given = F.try_variant_get(x, "$.type", "variant")
        kind_ = bound(F.when(kind(given) == "string", F.try_variant_get(given, "$", "string")), lambda t: F.when(t.isin(*TYPES), t).otherwise(F.lit(TYPES[0])))

        def rest(type_: Column) -> Column:
            return F.struct(
                type_.alias("type"),
                *[text_at(x, f"$.{k}").alias(k) for k in ("title", "address", "venue", "description")],
                F.struct(*[text_at(x, f"$.links.{k}").alias(k) for k in LINKS[:3]], other_links(x).alias("other"), extra(x, "$.links", LINKS).alias("extra")).alias("links"),
                F.struct(*[F.when(type_ == TYPES[1], F.lit(NOVALUE)).otherwise(text_at(x, f"$.event.{k}")).alias(k) for k in EVENT], extra(x, "$.event", EVENT).alias("extra")).alias("event"),
                extra(x, "$", TOP).alias("extra"),
            )

        return bound(kind_, rest)

    return bound(v, record)


def missing_keys(v: Column, path: str, required: tuple[str, ...]) -> Column:
    """Required keys that an object doesn't have, in order of their names."""
    has = [F.when(F.try_variant_get(v, f"{path}.{k}", "variant").isNull(), F.lit(k)) for k in sorted(required)]
    return F.array_compact(F.array(*has))


def validate(v: Column) -> Column:
    """The first fault of a record, null if there is none."""
    def lacks(x: Column, what: str, path: str, keys: tuple[str, ...]) -> Column:
        return bound(missing_keys(x, path, keys), lambda gone: F.when(F.size(gone) > 0, F.concat(F.lit(f"missing {what}: "), F.array_join(gone, ", "))))

    def is_no(x: Column, path: str, what: str, fault: str) -> Column:
        return F.when(~F.coalesce(kind(F.try_variant_get(x, path, "variant")) == what, F.lit(False)), F.lit(fault))

    return bound(v, lambda x: F.coalesce(
        is_no(x, "$", "object", "not an object"),
        lacks(x, "keys", "$", TOP),
        is_no(x, "$.links", "object", "links is no object"),
        lacks(x, "link keys", "$.links", LINKS),
        is_no(x, "$.event", "object", "event is no object"),
        lacks(x, "event keys", "$.event", EVENT),
        is_no(x, "$.links.other", "array", "links.other is no list"),
    ))


def validate_list(v: Column) -> Column:
    """The first fault of a list of records, with the item's number from 0; null if there is none."""
    def items(x: Column) -> Column:
        faults = F.transform(F.try_variant_get(x, "$", "array<variant>"), lambda item, i: F.concat(F.lit("item "), i.cast("string"), F.lit(": "), validate(item)))
        return F.when(kind(x) == "array", F.get(F.filter(faults, lambda f: f.isNotNull()), F.lit(0))).otherwise(F.lit("not a list"))

    return bound(v, lambda x: F.coalesce(items(x), F.when(x.isNull(), F.lit("not a list"))))
