"""What each image needs, against the rules read one image at a time; steps that fail, and steps that aren't taken."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from handbill.functions.jsons import strict_json
from handbill.operators import steps


def listing(spark, numbers):
    return spark.createDataFrame([(n, f"p{n}") for n in numbers], "idx int, path string")


@pytest.mark.parametrize("skip", [True, False])
def test_all_states(spark, skip):
    states = list(itertools.product([False, True], repeat=4))
    sides = [[n for n, s in enumerate(states) if s[k]] + [None] for k in range(4)]
    sides[0] += [12, 15]  # listed twice
    found = {r["idx"]: tuple(r)[1:] for r in steps.image_steps(*(listing(spark, s) for s in sides), skip_existing=skip).collect()}
    want = {}
    for n, (image, annotation, canvas, target) in enumerate(states):
        if not any(states[n]):
            continue
        if not image:
            want[n] = ("orphan", False, False, False)
            continue
        annotation, canvas, target = (skip and x for x in (annotation, canvas, target))
        read, render, aim = not annotation, not (annotation and canvas), not target
        want[n] = ("all" if read else "render" if render else "target" if aim else "nothing", read, render, aim)
    assert found == want


def test_steps_are_taken_once(spark, tmp_path):
    log = tmp_path / "log"

    def said(kind, what):
        with open(log, "a") as f:
            f.write(f"{kind} {what}\n")

    def reader(path):
        said("read", path)
        if path == "p2":
            raise OSError("gone")
        return "no json" if path == "p3" else json.dumps({"width": 100, "height": 50, "parsing_res_list": [{"block_content": path, "block_bbox": [10, 10, 90, 40]}] if path != "p4" else []})

    def provider(prompt):
        said("asked", "p1" if "p1" in prompt else "old" if "old" in prompt else "?")
        return 'so: {"events":[{"a":1}]}'

    body = json.dumps({"width": 100, "height": 50, "parsing_res_list": [{"block_content": "old", "block_bbox": [0, 0, 50, 50]}]})
    known = spark.createDataFrame([(n, body) for n in (5, 6, 7)], "idx int, t string").select("idx", strict_json(F.col("t")).alias("v"))
    images = listing(spark, range(1, 8))
    need = steps.image_steps(images, known, listing(spark, [6, 7]), listing(spark, [5, 7]))
    found = {r["idx"]: r for r in steps.take_steps(need, images, known, reader, provider).collect()}
    assert {k: r["step"] for k, r in found.items()} == {1: "all", 2: "all", 3: "all", 4: "all", 5: "render", 6: "target", 7: "nothing"}
    assert {k: r["error"] for k, r in found.items() if r["error"]} == {2: "OSError: gone", 3: "no JSON"}
    assert {k for k, r in found.items() if r["annotation"]} == {1, 4} and {k for k, r in found.items() if r["canvas"]} == {1, 5}
    assert {k: r["target"] for k, r in found.items() if r["target"]} == {1: '{"events":[{"a":1}]}', 4: '{"events":[]}', 6: '{"events":[{"a":1}]}'}
    assert sorted(log.read_text().splitlines()) == ["asked old", "asked p1", "read p1", "read p2", "read p3", "read p4"]
    assert steps.take_steps(need.where("false"), images, known, reader, provider).count() == 0
