"""Files, search cache, streams, layout and records on small fixtures."""

import json
import random
import struct
from datetime import date

import pytest
from pyspark.sql import functions as F

from handbill.operators import blocks, layout, records
from handbill.sources import files, search, sinks
from handbill.streaming import incremental


def write(folder, name, value):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")


def test_prediction_files(spark, tmp_path):
    e = [{"event_name": " A ", "venue": 5, "date": True, "time": None, "recurring": ""}, "stray", {"event_name": "B"}]
    write(tmp_path / "p", "prediction10.json", {"prediction": {"events": e}})
    write(tmp_path / "p", "prediction2.json", {"prediction": {"events": e[2:]}})
    write(tmp_path / "p", "prediction3.json", {"prediction": []})
    write(tmp_path / "p", "prediction4.json", "no json")
    write(tmp_path / "p", "other.json", {"prediction": {"events": e}})
    read = files.predictions(spark, str(tmp_path / "p"))
    assert sorted((r.file_name, r.idx, r.ok) for r in read.select("file_name", "idx", F.col("v").isNotNull().alias("ok")).collect()) == [
        ("prediction10.json", 10, True), ("prediction2.json", 2, True), ("prediction3.json", 3, True), ("prediction4.json", 4, False),
    ]
    rows = files.numbered(files.prediction_events(read), F.lit(0))
    assert [tuple(r) for r in rows.select("ordinal", "source", "pos", *files.FIELDS).orderBy("ordinal").collect()] == [
        (0, "prediction10.json", 0, "A", "5", "True", None, None), (1, "prediction10.json", 2, "B", None, None, None, None), (2, "prediction2.json", 0, "B", None, None, None, None),
    ]
    named = sinks.per_file(rows, read, "enriched_", F.col("event_name"))
    assert {r.file_name: r["items"] for r in named.collect()} == {"enriched_10.json": ["A", "B"], "enriched_2.json": ["B"], "enriched_3.json": [], "enriched_4.json": []}
    one = files.run_summary(read, rows, rows.limit(1)).first()
    assert (len(one.sources), one.n_input, one.n_output) == (4, 3, 1)


def test_sampled_seconds(spark):
    rows = spark.createDataFrame([('{"sampled_secs":[0,2]}',), ('{"trigger_secs":[1]}',), ("{}",)], "t string")
    assert [r[0] for r in rows.select(files.sampled_seconds(F.try_parse_json("t"))).collect()] == [[0, 2], [1], []]


def test_images_and_annotations(spark, tmp_path):
    (tmp_path / "i").mkdir()
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 200, 100)
    for name in ("out1.png", "out2.png", "outx.png", "no.png"):
        (tmp_path / "i" / name).write_bytes(png)
    images = files.images(spark, str(tmp_path / "i"))
    assert sorted(str(r.idx) for r in images.collect()) == ["1", "2", "None"]
    listed = [
        {"block_content": " b ", "block_bbox": [0, 0, 100, 50], "block_order": 2}, {"block_content": "", "block_bbox": [0, 0, 1, 1]}, {"block_content": "short", "block_bbox": [1, 2, 3]}, "stray",
        {"block_content": "poly", "block_poly": [[20, 10], [40, 10], [40, 30], [20, 30]]}, {"block_content": "last", "block_bbox": ["1", 2, 3.5, 4], "block_order": None},
    ]
    write(tmp_path / "a", "annotation1.json", {"width": 0, "height": 9, "parsing_res_list": listed})
    write(tmp_path / "a", "annotation2.json", {"width": 200, "height": 100, "rec_texts": ["x", "y", "z"], "rec_boxes": [[0, 0, 20, 10], [0, 0, 200, 100]]})
    write(tmp_path / "a", "annotation3.json", {"width": 200, "height": 100, "parsing_res_list": [], "rec_texts": ["x"], "rec_boxes": [[0, 0, 1, 1]]})
    notes = files.json_files(spark, str(tmp_path / "a"), "annotation*.json")
    made = blocks.build_blocks(files.annotation_items(notes, images.where("idx IS NOT NULL")))
    assert [tuple(r) for r in made.select("image", "place", "id", "text", "box", "order").orderBy("image", "place").collect()] == [
        (1, 1, 1, "poly", [100, 100, 200, 300], 1), (1, 2, 0, "b", [0, 0, 500, 500], 2), (1, 3, 2, "last", [5, 20, 18, 40], None),
        (2, 1, 0, "x", [0, 0, 100, 100], 0), (2, 2, 1, "y", [0, 0, 1000, 1000], 1),
    ]


def test_search_cache(spark, tmp_path):
    asked = search.requests(spark.createDataFrame([("é a", 0), ("b", 1), ("b", 2)], "search string, query_no int"), "http://e", gl="us")
    keys = {r.search: r.cache_key for r in asked.collect()}
    import hashlib

    assert keys["é a"] == hashlib.sha256(json.dumps({"endpoint": "http://e", "payload": {"q": "é a", "gl": "us", "num": 10}}, sort_keys=True).encode()).hexdigest()

    def provider(payload):
        q = json.loads(payload)["q"]
        return json.dumps({"organic": ["x", {"title": f" {q} ", "link": ""}, {"title": q, "snippet": None, "link": f" http://{q} "}, {"link": "http://c"}]})

    def never(payload):
        raise AssertionError(payload)

    cache = str(tmp_path / "cache")
    assert {r.raw for r in search.read_through(asked, cache).collect()} == {None}
    first = search.read_through(asked, cache, provider).withColumn("event", F.lit(7))
    again = search.read_through(asked, cache, never)
    assert search.cached(spark, cache).count() == 2 and again.where("raw IS NULL").isEmpty()
    found = search.event_evidence(first, "event", 2).first()
    assert [(e.title, e.snippet, e.url) for e in found.evidence] == [("é a", "", "http://é a"), ("", "", "http://c")]
    assert len(search.event_evidence(first, "event", 0).first().evidence) == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write(source, "prediction1.json", {"n": 1})
    write(source, "prediction2.json", "broken")

    def run(checkpoint):
        stream = incremental.json_stream(spark, str(source), "prediction*.json")
        work = lambda rows: rows.select("file_name", F.try_variant_get("v", "$.n", "int").alias("n"))
        incremental.incremental(stream, "file_name", out, str(tmp_path / checkpoint), work).awaitTermination()
        return sorted((r.file_name, r.n) for r in spark.read.parquet(out).collect())

    assert run("c") == [("prediction1.json", 1), ("prediction2.json", None)]
    write(source, "prediction3.json", {"n": 3})
    assert len(run("c")) == 3
    assert len(run("c")) == 3


def test_badges_against_plain_loop(spark):
    r = random.Random(3)
    made = []
    for image in range(8):
        for i in range(12):
            x, y = r.randint(0, 80), r.randint(0, 60)
            made.append((image, i, i, x, y, x + r.randint(1, 40), y + r.randint(1, 40), 100, 80, 24, 12))
    found = {(b.image, b.id): b.badge for b in layout.place_badges(spark.createDataFrame(made, "image int, place int, id int, x1 int, y1 int, x2 int, y2 int, width int, height int, badge_w int, badge_h int")).collect()}
    taken: dict[int, list] = {}
    for image, _, i, x1, y1, x2, y2, w, h, bw, bh in made:
        used = taken.setdefault(image, [])
        at = [(x, y) for y, xs in ((y1 - bh - 2, (x1, x2 - bw)), (y1 + 2, (x1 + 2, x2 - bw - 2)), (y2 + 2, (x1, x2 - bw))) for x in xs]
        free = [[x, y, x + bw, y + bh] for x, y in at if 0 <= x <= w - bw and 0 <= y <= h - bh and all(x + bw < u[0] or u[2] < x or y + bh < u[1] or u[3] < y for u in used)]
        x, y = max(0, min(w - bw, x1 + 2)), max(0, min(h - bh, y1 + 2))
        used.append(free[0] if free else [x, y, x + bw, y + bh])
        assert found[image, i] == used[-1]


def test_wrap_fit_and_canvas(spark):
    rows = spark.createDataFrame([(0, 1, 0, "aa bb\n\ncccccccc d <", 0.0, 0.0, 60.5, 400.0, 100, 200), (0, 2, 1, "x", 5.0, 5.0, 5.2, 9.0, 100, 200)], "image int, place int, id int, text string, x1 double, y1 double, x2 double, y2 double, width int, height int")
    lines = rows.select(layout.wrap(F.col("text"), F.lit(10), F.lit(30.0)), layout.fit(F.lit("word " * 50), F.lit(40), F.lit(40))["size"]).first()
    assert lines[0] == ["aa bb", "", "cccccccc", "d <"] and lines[1] == 8
    svg = layout.canvas(rows).collect()
    assert len(svg) == 1 and svg[0].svg.count(">B") == 1 and "&lt;" in svg[0].svg and 'width="100" height="200"' in svg[0].svg


def test_when_takes_a_files_year(spark):
    rows = [("f", 0, "Mar 20", "7 pm", "Gala 2024", None), ("f", 1, "2025-01-02", None, None, None), ("g", 0, "Mar 20", "5-7pm", None, None), ("g", 1, None, None, None, None), ("g", 2, "tbd", "x", None, None)]
    made = records.normalize_when(spark.createDataFrame(rows, "source string, pos int, date string, time string, event_name string, venue string"), date(2026, 3, 15))
    assert [tuple(r) for r in made.orderBy("source", "pos").select("start_date", "start_time", "end_date", "end_time").collect()] == [
        ("2024-03-20", "19:00", "2024-03-20", "NOVALUE"), ("2025-01-02", "NOVALUE", "2025-01-02", "NOVALUE"),
        ("2026-03-20", "17:00", "2026-03-20", "19:00"), ("NOVALUE", "NOVALUE", "NOVALUE", "NOVALUE"), ("NOVALUE", "NOVALUE", "NOVALUE", "NOVALUE"),
    ]


def test_records_from_answers(spark):
    def provider(prompt):
        if prompt == "fails":
            raise ValueError("down")
        if prompt.startswith(records.REPAIR):
            return '[{"title":"mended"}]' if "fix" in prompt else "still no"
        return {"list": 'x [{"title":" T "}, {"title":"U"}] y', "object": '{"title":"T"}', "empty": "[]", "fix": "fix me", "never": "bad"}[prompt]

    asked = spark.createDataFrame([(p, p) for p in ("list", "object", "empty", "fix", "never", "fails")], "k string, prompt string")
    found = {r.k: (r.record and r.record.title, r.error) for r in records.merge_records(asked, provider).collect()}
    assert found == {"list": ("T", None), "object": (None, "no JSON array"), "empty": ("NOVALUE", None), "fix": ("mended", None), "never": (None, "no JSON array"), "fails": (None, "ValueError: down")}


def test_training_samples(spark):
    paths = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "idx int, path string")
    targets = spark.createDataFrame([(1, '[{"x":1}]'), (2, '"text"')], "idx int, t string").select("idx", F.try_parse_json("t").alias("v"))
    made = records.training_samples(paths, paths.where("idx = 1"), spark.createDataFrame([(1, "[B]"), (2, "[]")], "idx int, prompt string"), targets, "say {blocks}!")
    one, two = made.orderBy("idx").collect()
    assert one.missing == [] and [c.text for c in one.messages[0].content] == [None, None, "say [B]!"] and one.messages[1].content[0].text == '{"events":[{"x":1}]}'
    assert two.messages is None and two.missing == ["canvas", "target"]


def test_order_choice_and_empty(spark, tmp_path):
    for name in ("out10.png", "out2.png", "outside.png"):
        (tmp_path / name).write_bytes(b"x")
    found = files.images(spark, str(tmp_path))
    assert [r["idx"] for r in files.in_order(found).collect()] == [None, 2, 10]
    assert [r["idx"] for r in files.in_order(found, missing_last=True).collect()] == [2, 10, None]
    assert [r["idx"] for r in files.required(files.images(spark, str(tmp_path), only=2), "image").collect()] == [2]
    with pytest.raises(FileNotFoundError):
        files.required(found.where("idx = 3"), "image 3")


def test_messages_and_page_targets(spark):
    side = spark.createDataFrame([(1, bytearray(b"\x89PNG")), (2, bytearray(b"two"))], "idx int, content binary")
    made = records.vision_messages(side, side, spark.createDataFrame([(1, "[]"), (3, "[]")], "idx int, prompt string"), "see {blocks}").collect()
    assert len(made) == 1 and made[0]["messages"][0]["role"] == "user"
    parts = made[0]["messages"][0]["content"]
    assert [p["type"] for p in parts] == ["image_url", "image_url", "text"] and parts[0]["image_url"]["url"] == "data:image/png;base64,iVBORw==" and parts[2]["text"] == "see []"

    def provider(prompt):
        if prompt == "fail":
            raise RuntimeError("gone")
        assert prompt != "none"
        return prompt

    pages = spark.createDataFrame([(1, 0, "none"), (2, None, "none"), (3, 1, 'so: [{"event_name":"a"}]'), (4, 2, "nothing"), (5, 1, "fail")], "idx int, n_blocks int, prompt string")
    found = {r["idx"]: (r["target"], r["error"]) for r in records.page_targets(pages, provider).collect()}
    assert found == {1: ('{"events":[]}', None), 2: ('{"events":[]}', None), 3: ('{"events":[{"event_name":"a"}]}', None), 4: ('{"events":[]}', None), 5: (None, "RuntimeError: gone")}


def test_labels_are_left_out(spark):
    items = spark.createDataFrame([(1, 0, "a", "text"), (1, 1, "b", "footer"), (1, 2, "c", None)], "image int, pos int, text string, label string")
    items = items.select("*", *[F.lit(float(v)).alias(c) for c, v in (("x1", 0), ("y1", 0), ("x2", 5), ("y2", 5), ("width", 10), ("height", 10))], F.lit(None).cast("int").alias("order"))
    assert [r["text"] for r in blocks.build_blocks(items, drop_labels=("footer",)).orderBy("place").collect()] == ["a", "c"]
    assert blocks.build_blocks(items).count() == 3


def test_prediction_records(spark):
    paths = spark.createDataFrame([(i, f"p{i}") for i in range(1, 7)] + [(None, "stray")], "idx int, path string")
    pages = spark.createDataFrame([(i, f"a{i}", i, f"prompt {i}") for i in (1, 2, 3, 5, 6)], "idx int, path string, n_blocks int, prompt string")
    targets = spark.createDataFrame([(1, '{"events":[]}')], "idx int, t string").select("idx", F.parse_json("t").alias("v"))
    laid = spark.createDataFrame([(5, 0), (5, None), (6, None)], "image int, order int")
    faults = blocks.order_faults(laid).withColumnRenamed("image", "idx")

    def provider(prompt):
        if prompt == "prompt 3":
            raise RuntimeError("gone")
        return '[{"event_name":"x"}]' if prompt == "prompt 1" else "no json"

    found = {r["idx"]: (r["error"], json.loads(r["record"])) for r in records.prediction_records(paths, paths.where("idx <> 2"), pages, targets, faults, provider).collect()}
    assert {k: v[0] for k, v in found.items()} == {1: None, 2: "missing files: canvas", 3: "RuntimeError: gone", 4: "missing files: annotation", 5: "a block has no order to sort by", 6: None}
    assert found[1][1] == {"index": 1, "image": "p1", "canvas": "p1", "annotation": "a1", "num_blocks": 1, "prediction": [{"event_name": "x"}], "raw_output": '[{"event_name":"x"}]', "target": {"events": []}}
    assert found[6][1]["raw_output"] == "no json" and found[2][1] == {"index": 2, "image": "p2", "annotation": "a2", "error": "missing files: canvas"}
