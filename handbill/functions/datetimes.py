"""Dates and times as they stand on flyers, to ISO text or NOVALUE."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handbill.functions.text import NOVALUE, SPACE, spare, strip

# The patterns of a year and of a time of day, and the days that a date may be past and still this year's.
YEAR = r"\b(19\d{2}|20\d{2})\b"
TIME = r"(?i)(\d{1,2})(?::(\d{2}))?\s*(am|pm)?"
GRACE_DAYS = 30


def year_hint(c: Column) -> Column:
    """The first year named in a text, or null."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), YEAR, 1), F.lit("")).cast("int")


def nearest_upcoming(month: Column, day: Column, today: date) -> Column:
    """This year's date unless it is more than GRACE_DAYS past, else next year's; null if there is none."""
    this, following = (F.try_to_date(F.format_string("%04d-%02d-%02d", F.lit(y), month, day), "yyyy-MM-dd") for y in (today.year, today.year + 1))
    given = month.isNotNull() & day.isNotNull()
    return F.when(given & this.isNotNull(), F.when(F.datediff(this, F.lit(today)) >= -GRACE_DAYS, this).otherwise(following))


# Names of months and days of the week, in order.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def named(words: tuple[str, ...]) -> str:
    """A pattern of whole names, or their first three letters."""
    return "|".join(f"{w[:3]}(?:{w[3:]})?" if w[3:] else w for w in words)


WEEKDAY = rf"(?:(?:{named(DAYS)}),? +)?"
DAY = r"(0?[1-9]|[12]\d|3[01])(?:st|nd|rd|th)?"
#: Month and day, or day and month, perhaps after a day of the week, perhaps with a year: [month, day, day, month, year].
PLAIN_DATE = rf"^{WEEKDAY}(?:({named(MONTHS)}) +{DAY}|{DAY} +({named(MONTHS)}))(?:,? +(19\d\d|20\d\d))?$"


def plain_date(text: Column, hint: Column, today: date) -> Column:
    """ISO date or NOVALUE of texts that name month and day plainly, as the parser reads them; null for all others, which are the parser's.

    One look by a pattern, then numbers: a date of the text's year, else of the hint's, else the nearest upcoming one.
    """
    parts = F.regexp_replace(F.lower(F.btrim(text)), PLAIN_DATE, "$1$4|$2$3|$5")

    def part(k: int) -> Column:
        return F.nullif(F.split_part(parts, F.lit("|"), F.lit(k)), F.lit(""))

    found = parts.rlike(r"^[a-z]+\|\d+\|\d*$") & ~text.contains("|")
    month = F.when(found, ((F.instr(F.lit("".join(m[:3] for m in MONTHS)), F.substring(part(1), 1, 3)) + 2) / 3).cast("int"))
    day, year = F.when(found, part(2).cast("int")), F.when(found, part(3).cast("int"))
    dated = F.try_to_date(F.format_string("%04d-%02d-%02d", F.coalesce(year, hint), month, day), "yyyy-MM-dd")
    when = F.when(hint.isNotNull(), F.coalesce(dated, F.when(year.isNull(), nearest_upcoming(month, day, today)))).otherwise(nearest_upcoming(month, day, today))
    return F.when(found & (hint.isNotNull() | year.isNull()), F.coalesce(when.cast("string"), F.lit(NOVALUE)))


def parse_free(text: str, hint: int | None, today: date) -> str:
    from dateutil import parser

    if hint is not None:
        try:
            return parser.parse(text, default=datetime(hint, 1, 1)).date().isoformat()
        except (ValueError, OverflowError, TypeError):
            pass
    try:
        found = parser.parse(text, default=datetime(today.year, 1, 1)).date()
        here = found.replace(year=today.year)
        return (here if (here - today).days >= -GRACE_DAYS else here.replace(year=today.year + 1)).isoformat()
    except (ValueError, OverflowError, TypeError):
        return NOVALUE


def free_date(today: date):
    """An Arrow function (text, hint) -> ISO date or NOVALUE, each distinct pair of a batch parsed once."""

    @F.pandas_udf("string")
    def parsed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[tuple, str] = {}
        for texts, hints in batches:
            keys = [(t, None if pd.isna(h) else int(h)) for t, h in zip(texts, hints, strict=True)]
            known |= {k: parse_free(*k, today) for k in set(keys) - known.keys()}
            yield pd.Series([known[k] for k in keys], dtype=object)

    return parsed


def iso_date(c: Column) -> Column:
    """A text that is an ISO date already, or null: the path that needs no parser."""
    text = strip(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd"))


def clock(hour: Column, minute: Column, half: Column) -> Column:
    """HH:MM of 12- or 24-hour parts, or null where they are out of range."""
    h = F.when(half == "pm", F.when(hour == 12, hour).otherwise(hour + 12)).when(half == "am", F.when(hour == 12, F.lit(0)).otherwise(hour)).otherwise(hour)
    fits = (hour <= 23) & (minute <= 59) & F.when(half != "", hour.between(1, 12)).otherwise(F.lit(True))
    return F.when(fits, F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0")))


def with_times(events: DataFrame, time: str = "time") -> DataFrame:
    """events with start_time and end_time of a time or a range of times; a side without am or pm takes the other's.

    Built in steps, as text.with_queries is: no expression is worked out twice, and all are compiled.
    """
    sides = ("whole", "left", "right")
    raw, ranged_, tidy, *names = spare(events, "t_raw", "t_ranged", "t_tidy", *(f"t_{s}{k}" for s in sides for k in ("", "_h", "_m", "_half")), "t_first", "t_second", "t_single")
    (whole, *w), (left, *a), (right, *b) = (names[4 * k : 4 * k + 4] for k in range(3))
    first, second, single = names[12:]
    dash, match = F.col(ranged_), r"(?s)^.*?" + TIME + ".*$"
    rows = events.withColumn(raw, F.translate(F.lower(strip(F.coalesce(F.col(time), F.lit("")))), "–—", "--"))
    rows = rows.withColumn(ranged_, F.col(raw).contains("-"))
    # parts between dashes that aren't blank, one dash apart
    rows = rows.withColumn(tidy, F.when(dash, F.btrim(F.regexp_replace(raw, f"{SPACE}*-(?:{SPACE}|-)*", "-"), F.lit("-"))).otherwise(F.col(raw)))
    rows = rows.withColumns({left: F.split_part(tidy, F.lit("-"), F.lit(1)), right: F.when(dash, F.split_part(tidy, F.lit("-"), F.lit(2))), whole: F.when(dash, F.col(raw))})
    # one look for hour, minute and half of each: what has no time stays as it is, and is no number
    rows = rows.withColumns({x: F.regexp_replace(x, match, "$1|$2|$3") for x in (left, right, whole)})
    rows = rows.withColumn(whole, F.coalesce(whole, left))
    parts = {}
    for text, (h, m, half) in ((whole, w), (left, a), (right, b)):
        h_, m_, half_ = (F.split_part(text, F.lit("|"), F.lit(k)) for k in (1, 2, 3))
        timed = F.col(text).rlike(r"^\d{1,2}\|")  # a cast that fails is slow, as it is an exception underneath
        parts |= {h: F.when(timed, h_.cast("int")), m: F.when(timed & (m_ != ""), m_.cast("int")).otherwise(F.lit(0)), half: F.when(timed, half_).otherwise(F.lit(""))}
    rows = rows.withColumns(parts)

    def other(own: str, beside: str) -> Column:
        return F.when(F.col(own) == "", F.col(beside)).otherwise(F.col(own))

    rows = rows.withColumns({
        first: clock(F.col(a[0]), F.col(a[1]), other(a[2], b[2])), second: clock(F.col(b[0]), F.col(b[1]), other(b[2], a[2])), single: clock(*map(F.col, w)),
    })
    ranged = dash & F.col(first).isNotNull() & F.col(second).isNotNull()
    start = F.when(ranged, F.col(first)).otherwise(F.coalesce(single, F.lit(NOVALUE)))
    kept = [c for c in events.columns if c.lower() not in ("start_time", "end_time")]
    return rows.select(*kept, start.alias("start_time"), F.when(ranged, F.col(second)).otherwise(F.lit(NOVALUE)).alias("end_time"))
