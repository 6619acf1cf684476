"""Text: cleaning, names, coercion, file-name suffixes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that str.strip() removes, as characters and as a regular-expression class.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: What stands for a missing value in final records.
NOVALUE = "NOVALUE"


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c worked out once, however often f names it: the optimiser would write it out each time."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def clean_text(c: Column) -> Column:
    """Non-breaking spaces to spaces, CR to LF, lines stripped, empty ones dropped; null as ''."""
    lines = F.split(F.translate(F.coalesce(c, F.lit("")), "\u00a0\r", " \n"), "\n")
    return F.array_join(F.filter(F.transform(lines, strip), lambda x: x != ""), "\n")


def norm_name(c: Column) -> Column:
    """A name for fuzzy comparison: lower case, only a-z, 0-9 and single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def coerce(c: Column) -> Column:
    """Stripped text, null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def coerce_novalue(c: Column) -> Column:
    return F.coalesce(coerce(c), F.lit(NOVALUE))


def numeric_suffix(stem: Column) -> Column:
    """The number that ends a file's stem, or null."""
    return F.nullif(F.regexp_extract(stem, r"(\d+)$", 1), F.lit("")).try_cast("int")


def digits(stem: Column) -> Column:
    """All digits of a stem as one number, or null."""
    return F.nullif(F.regexp_replace(stem, r"\D", ""), F.lit("")).try_cast("bigint")


def sibling_paths(root: Column, idx: Column) -> Column:
    """The paths that belong to one index: image, annotation, canvas, target, prediction."""
    parts = [("image", "images/out", "png"), ("annotation", "annotations/annotation", "json"), ("canvas", "canvas/canvas", "png"), ("target", "targets/target", "json"), ("prediction", "predictions/prediction", "json")]
    return F.struct(*[F.concat(root, F.lit(f"/{stem}"), idx.cast("string"), F.lit(f".{kind}")).alias(name) for name, stem, kind in parts])


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names like these that df has no columns of, whatever the case of their letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_queries(events: DataFrame, name: str, venue: str, date: str, time: str, out: str = "queries") -> DataFrame:
    """events with an array of search queries of each, at most six, distinct but for case; none without name and venue.

    Built in steps, each a projection of its own: the optimiser leaves those apart whose columns the next names more than
    once, so nothing is worked out twice and all of it is compiled.
    """
    n, v, d, t, base, *made = spare(events, "q_name", "q_venue", "q_date", "q_time", "q_base", *(f"q_{k}" for k in range(6)), *(f"q_{k}_low" for k in range(6)))
    each, low = made[:6], made[6:]
    parts = dict(zip((n, v, d, t), (name, venue, date, time), strict=True))
    rows = events.withColumns({k: F.trim(F.translate(F.coalesce(F.col(c), F.lit("")), BLANKS, " " * len(BLANKS))) for k, c in parts.items()})
    rows = rows.withColumns({k: F.when(F.col(k).contains("  "), F.regexp_replace(k, " {2,}", " ")).otherwise(F.col(k)) for k in parts})
    both = (F.col(n) != "") & (F.col(v) != "")
    rows = rows.withColumn(base, F.when(both, F.concat(n, F.lit(" "), v)).otherwise(F.concat(n, v)))
    raw = [F.col(base), *[F.when(both, F.concat(n, F.lit(f" {word} "), v)) for word in ("tickets", "reservation", "hours admission")]]
    raw += [F.when(F.col(x) != "", F.concat(base, F.lit(" "), x)) for x in (d, t)]
    rows = rows.withColumns({k: F.when(F.col(base) != "", x) for k, x in zip(each, raw, strict=True)})
    rows = rows.withColumns({b: F.lower(a) for a, b in zip(each, low, strict=True)})
    first = [F.when(~F.coalesce(F.col(low[k]).isin(*map(F.col, low[:k])), F.lit(False)), F.col(each[k])) if k else F.col(each[0]) for k in range(6)]
    return rows.withColumn(out, F.array_compact(F.array(*first))).drop(n, v, d, t, base, *each, *low)
