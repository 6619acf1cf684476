"""Golden rows of the scalar functions."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from handbill.functions import datetimes, geometry, jsons, schema, text

TODAY = date(2026, 3, 15)


def values(spark, inputs, make):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r["y"] for r in rows.withColumn("y", make(F.col("x"))).orderBy("i").collect()]


def test_clean_text(spark):
    assert values(spark, ["  a b \r\n\n \x1c c\t", None, ""], text.clean_text) == ["a b\nc", "", ""]


def test_norm_name(spark):
    assert values(spark, ["  Jazz--Night! ", "東京", None], text.norm_name) == ["jazz night", "", ""]


def test_times(spark):
    golden = {
        "7 pm": ("19:00", "NOVALUE"), "5 - 8:30 pm": ("17:00", "20:30"), "7 pm – 9 pm": ("19:00", "21:00"), "noon": ("NOVALUE", "NOVALUE"), "730pm": ("NOVALUE", "NOVALUE"),
        "3rd floor, 7pm": ("03:00", "NOVALUE"), "10:5pm": ("10:00", "NOVALUE"), "7p.m.": ("07:00", "NOVALUE"), "5 to 8 pm": ("05:00", "NOVALUE"), "-7 pm": ("19:00", "NOVALUE"),
        "7:30 pm": ("19:30", "NOVALUE"), "11 - 1 pm": ("23:00", "13:00"), "19:00-21:00": ("19:00", "21:00"), "24:00": ("NOVALUE", "NOVALUE"), "13 pm": ("NOVALUE", "NOVALUE"),
        "12 am": ("00:00", "NOVALUE"), "2026-04-04": ("20:00", "04:00"), "6pm-late": ("18:00", "NOVALUE"), "25 - 7 pm": ("NOVALUE", "NOVALUE"), "": ("NOVALUE", "NOVALUE"),
    }
    golden |= {"- - 7pm": ("19:00", "NOVALUE"), "5 - - 6 pm -": ("17:00", "18:00"), " 5\u00a0-\t6 pm - 9": ("17:00", "18:00")}
    rows = spark.createDataFrame([(x,) for x in golden], "time string").withColumn("t_raw", F.lit(1)).withColumn("START_TIME", F.lit("x"))
    found = {r["time"]: (r["start_time"], r["end_time"]) for r in datetimes.with_times(rows).collect()}
    assert found == golden and datetimes.with_times(rows).columns == ["time", "t_raw", "start_time", "end_time"]


@pytest.mark.parametrize("given, hint, expected", [
    ("MAR 01", None, "2026-03-01"), ("FEB 01", None, "2027-02-01"), ("FEB 01", 2025, "2025-02-01"), ("Feb 29", None, "NOVALUE"), ("12 April 2025", 2025, "2025-04-12"), ("tbd", None, "NOVALUE"), ("Friday", None, "2027-01-02"), ("04/05", 2025, "2025-04-05"),
])
def test_free_dates(given, hint, expected):
    assert datetimes.parse_free(given, hint, TODAY) == expected


def test_json_parsers(spark):
    texts = ['{"events":[{"a":1}]}', '[{"a":1}]', '[{"a":1},{"b":2}]', '```json {"events":[]} ```', "nonsense", "[1] x", '{"a":1}, {"b":2}']
    rows = jsons.with_attempts(spark.createDataFrame(list(enumerate(texts)), "j_0 int, t string"), "t")
    assert rows.columns == ["j_0", "t", "whole", "braces", "brackets"]
    found = rows.select("j_0", F.size(jsons.events_in()), jsons.kind(jsons.any_of()), jsons.object_of().isNotNull(), jsons.kind(jsons.extract_any(F.col("t")))).orderBy("j_0").collect()
    assert [r[1] for r in found] == [1, 1, 2, 0, None, 1, None]
    assert [r[2] for r in found] == [r[4] for r in found] and [r[2] for r in found][:6] == ["object", "array", "array", "array", None, "array"]
    assert [r[3] for r in found] == [True, True, False, True, False, False, False]


def test_kinds(spark):
    assert values(spark, ["{}", "[]", '"{"', "true", "false", "null", "1", "-2.5", "1e99", None], lambda x: jsons.kind(F.try_parse_json(x))) == ["object", "array", "string", "boolean", "boolean", "void", "number", "number", "number", None]


def test_queries(spark):
    rows = spark.createDataFrame([("Jazz  Night", "Blue Note", "Apr 4", "8 PM"), (None, None, "x", "y"), (None, "Blue Note", None, None)], "n string, v string, d string, t string")
    found = [r["queries"] for r in text.with_queries(rows, *"nvdt").collect()]
    assert found[0] == [f"Jazz Night{x}" for x in (" Blue Note", " tickets Blue Note", " reservation Blue Note", " hours admission Blue Note", " Blue Note Apr 4", " Blue Note 8 PM")]
    assert found[1:] == [[], ["Blue Note"]]


def test_geometry(spark):
    rows = spark.createDataFrame([(1.0, 2000.0), (3.0, 2000.0), (99.95, 100.0), (-5.0, 100.0), (1.0, 0.0)], "v double, s double")
    assert [r[0] for r in rows.select(geometry.to_thousand(F.col("v"), F.col("s"))).collect()] == [0, 2, 1000, 0, None]
    videos = spark.createDataFrame([(301, 30.0), (250, 25.0)], "total long, fps double")
    assert [(r["sec"], r["frame"]) for r in geometry.sample_plan(videos.limit(1), 2.0).collect()] == [(0, 0), (2, 60), (4, 120), (6, 180), (8, 240), (10, 300)]
    assert [r["sec"] for r in geometry.sample_plan(videos.where("total = 250"), 3.5).collect()] == [0, 4, 8]


def test_schema(spark):
    found = values(spark, ["{}", '{"type":"attraction","event":{"start_date":"2026-04-04"}}', '{"links":{"other":[" a ","a",1,"b","c","d"]}}'], lambda x: schema.ensure_schema(jsons.strict_json(x)))
    assert found[0]["type"] == "event" and found[0]["links"]["other"] == [] and found[0]["title"] == "NOVALUE"
    assert found[1]["event"]["start_date"] == "NOVALUE"
    assert found[2]["links"]["other"] == ["a", "b", "c"]


def test_schema_values_and_extra_members(spark):
    """Numbers, booleans, nulls and members that the schema doesn't name."""
    body = '{"type":"attraction","title":5,"address":true,"venue":null,"description":"  x ","note":[1,2],"links":{"website":2.5,"tickets":" ","other":["a"," a ",3,"","b","c","d"],"map":"m"},"event":{"start_date":"2026-01-01","room":7}}'
    rows = spark.createDataFrame([(1, body), (2, "{}"), (3, "[]"), (4, None), (5, '{"event":{"start_time":19,"end_time":" 20:00 "},"type":"concert"}')], "k int, t string")
    found = {r["k"]: r["r"] for r in rows.select("k", schema.ensure_schema(jsons.strict_json(F.col("t"))).alias("r")).collect()}
    first = found[1]
    assert (first["title"], first["address"], first["venue"], first["description"]) == ("5", "True", "NOVALUE", "x")
    assert (first["links"]["website"], first["links"]["tickets"], first["links"]["other"]) == ("2.5", "NOVALUE", ["a", "b", "c"])
    assert first["extra"] == {"note": "[1,2]"} and first["links"]["extra"] == {"map": '"m"'} and first["event"]["extra"] == {"room": "7"}
    assert first["event"]["start_date"] == "NOVALUE"
    assert all(found[k]["type"] == "event" and found[k]["title"] == found[k]["event"]["end_time"] == "NOVALUE" and found[k]["links"]["other"] == [] for k in (2, 3, 4))
    assert (found[5]["type"], found[5]["event"]["start_time"], found[5]["event"]["end_time"]) == ("event", "19", "20:00")


def test_faults_in_order(spark):
    whole = '"type":"","title":"","address":"","venue":"","description":""'
    links, event = '{"website":"","tickets":"","reservation":"","other":1}', "{}"
    cases = {f"{{{whole},\"links\":{links},\"event\":{event}}}": "missing event keys: end_date, end_time, recurring_weekday, recurring_weekly, start_date, start_time", f"{{{whole},\"links\":{links},\"event\":3}}": "event is no object", "7": "not an object"}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").withColumn("v", jsons.strict_json(F.col("t")))
    assert {r["t"]: r["fault"] for r in rows.select("t", schema.validate(F.col("v")).alias("fault")).collect()} == cases
    listed = spark.createDataFrame([("[]",), ("[{},3]",), ("{}",), ("no",)], "t string").select("t", schema.validate_list(jsons.strict_json(F.col("t"))).alias("f")).collect()
    assert [r["f"] for r in listed] == [None, "item 0: missing keys: address, description, event, links, title, type, venue", "not a list", "not a list"]


def test_distinct_queries(spark):
    row = spark.createDataFrame([(" Jazz ", "Blue Note", None, " 8 PM"), (None, " ", "d", "t"), ("A", "a", "", "")], "n string, v string, d string, t string")
    found = [r["queries"] for r in text.with_queries(row.withColumn("Q_NAME", F.lit(1)), *"nvdt").collect()]
    assert found == [["Jazz Blue Note", "Jazz tickets Blue Note", "Jazz reservation Blue Note", "Jazz hours admission Blue Note", "Jazz Blue Note 8 PM"], [], ["A a", "A tickets a", "A reservation a", "A hours admission a"]]


def test_plain_dates_are_read_as_the_parser_reads_them(spark):
    """Golden texts and fuzz: whatever the grammar takes, the parser says the same; what it refuses is null."""
    r = random.Random(6)
    names = [m for x in datetimes.MONTHS for m in (x, x[:3], x.upper(), x[:3].title())]
    texts = ["Apr 4", "4 April", "Friday, April 4", "Fri April 4th", "april 4, 2025", "4th April 2025", "Feb 29", "Feb 30", "29 Feb 2024", "31 June", " May 1 ", "may", "Sept 4", "Apr. 4", "Apr 4 - 6", "4/5", "04 Apr 26", "Apr 2026", "tonight", "", "|", "a|1|"]
    for _ in range(300):
        m, d = r.choice(names), f"{r.randint(0, 33)}{r.choice(['', '', 'st', 'th'])}"
        body = r.choice([f"{m} {d}", f"{d} {m}", f"{m}  {d}"])
        texts.append(r.choice(["", "", "Monday ", "sat, ", "on "]) + body + r.choice(["", "", " 2025", ", 2027", ",  1999", " 26", " 7 pm"]))
    for today in (TODAY, date(2028, 1, 10)):
        rows = spark.createDataFrame([(t, h) for t in texts for h in (None, 2025, 2028)], "t string, h int")
        found = rows.withColumn("d", datetimes.plain_date(F.col("t"), F.col("h"), today)).collect()
        taken = [(x["t"], x["h"], x["d"]) for x in found if x["d"] is not None]
        assert len(taken) > 300
        for t, h, d in taken:
            assert d == datetimes.parse_free(t, h, today), (t, h)
