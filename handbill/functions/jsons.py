"""JSON as models write it: strict parsing, and what can be saved from text around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handbill.functions.text import bound, coerce, spare


#: How any JSON value begins and ends. What doesn't is not parsed: a parser that fails is slow, as it is an exception underneath.
SHAPE = r"""(?s)^\s*(?:\{.*\}|\[.*\]|".*"|-?[0-9][0-9.eE+-]*|true|false|null)\s*$"""


def shaped(c: Column) -> Column:
    """The text, or null where it can't be a JSON value."""
    return F.when(c.rlike(SHAPE), c)


def strict_json(c: Column) -> Column:
    """A text's JSON value as a variant; null unless the whole text is one value.

    Spark's parser reads over what follows a value; inside an array and inside an object it can't.
    """
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), shaped(c), F.lit("]"))), "$", "array<variant>")
    member = F.try_parse_json(F.concat(F.lit('{"x":'), c, F.lit("}"))).isNotNull()
    return bound(listed, lambda x: F.when((F.size(x) == 1) & member, F.get(x, F.lit(0))))


def kind(v: Column) -> Column:
    """object, array, string, boolean, void or number, by the first letter of its JSON; null for null."""
    kinds = {"{": "object", "[": "array", '"': "string", "t": "boolean", "f": "boolean", "n": "void"}
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.substring(F.to_json(v), 1, 1))
    return F.when(v.isNotNull(), F.coalesce(found, F.lit("number")))


def between(c: Column, opening: str, closing: str) -> Column:
    """From the first opening bracket to the last closing one, or null."""
    first, last = F.instr(c, opening), F.length(c) - F.instr(F.reverse(c), closing) + 1
    return F.when((first > 0) & (F.instr(c, closing) > 0) & (last > first), F.substring(c, first, last - first + 1))


def extract_any(c: Column) -> Column:
    """The first attempt that gives any value: the whole text, from [ to ], from { to }; else null."""
    return F.coalesce(strict_json(c), strict_json(between(c, "[", "]")), strict_json(between(c, "{", "}")))


def with_attempts(rows: DataFrame, text: str, whole: str = "whole", braces: str = "braces", brackets: str = "brackets") -> DataFrame:
    """rows with three variants: the JSON value of the whole text, from { to }, and from [ to ]; null where there is none.

    Each is parsed once, and what is the whole text again is not parsed again: object_of, any_of and events_in read them.
    """
    inner = [("{", "}"), ("[", "]")]
    part, listed, own = spare(rows, *(f"j_{k}" for k in range(2))), spare(rows, *(f"j_list_{k}" for k in range(3))), [whole, braces, brackets]
    found = rows.withColumns({p: between(F.col(text), *pair) for p, pair in zip(part, inner, strict=True)})
    first = spare(found, "j_text")[0]
    found = found.withColumns({p: F.when(F.col(p) != F.col(text), shaped(F.col(p))) for p in part} | {first: shaped(F.col(text))})
    texts = [F.col(first), *map(F.col, part)]
    found = found.withColumns({x: F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$", "array<variant>") for x, t in zip(listed, texts, strict=True)})
    # Spark's parser reads over what follows a value; inside an array and inside an object it can't
    member = [F.try_parse_json(F.concat(F.lit('{"x":'), t, F.lit("}"))).isNotNull() for t in texts]
    return found.withColumns({n: F.when(F.size(x) == 1, F.when(m, F.get(x, F.lit(0)))) for n, x, m in zip(own, listed, member, strict=True)}).drop(first, *part, *listed)


def object_of(whole: str = "whole", braces: str = "braces", brackets: str = "brackets") -> Column:
    """The first attempt that is an object: the whole text, from { to }, from [ to ]; else null."""
    return F.coalesce(*[F.when(kind(F.col(x)) == "object", F.col(x)) for x in (whole, braces, brackets)])


def any_of(whole: str = "whole", braces: str = "braces", brackets: str = "brackets") -> Column:
    """The first attempt that is any value: the whole text, from [ to ], from { to }; else null."""
    return F.coalesce(whole, brackets, braces)


def list_in(v: Column) -> Column:
    """A list's elements; null for anything else."""
    return F.when(kind(v) == "array", F.try_variant_get(v, "$", "array<variant>"))


def events_of(v: Column) -> Column:
    """A value's events: its own list, or the list under `events` of an object; else null."""
    return F.when(kind(v) == "object", list_in(F.try_variant_get(v, "$.events", "variant"))).otherwise(list_in(v))


def events_in(whole: str = "whole", braces: str = "braces", brackets: str = "brackets") -> Column:
    """Events of the first attempt that has any list of them: the whole text, from { to }, from [ to ]; else null."""
    return F.coalesce(*[events_of(F.col(x)) for x in (whole, braces, brackets)])


def text_field(v: Column, name: str) -> Column:
    """A member as stripped text, null if it is missing, null or blank."""
    return coerce(F.try_variant_get(v, f"$.{name}", "string"))
