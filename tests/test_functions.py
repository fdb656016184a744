"""Functions and operators on hand-made edge rows, against plain Python."""

import hashlib
import json
import random
import time
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import keys, responses, semantic
from tessera.operators import backends, scenes, stages
from tessera.plans.detections import KIND
from tessera.sources.annotations import annotation_array, shard_of
from tessera.streaming.ingest import ingest


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first().r


def test_suffix_and_shard(spark):
    urls = ["a/b.JPG?x=1", "a/b.jpeg/", "a/.jpg", "a/x.tar.gz", "a/b.jpg#f", "a/noext", "a/b.svg", "a/c.tiff?q=.png", "é/ü.png"]
    for u in urls:
        s = PurePosixPath(u.split("?")[0]).suffix.lower()
        assert one(spark, u, keys.url_suffix) == (s if s[1:] in keys.SUFFIXES else ".jpg"), u
        for m in (1, 2, 7, 1000):
            assert one(spark, u, lambda c, m=m: keys.md5_shard(c, m)) == int(hashlib.md5(u.encode()).hexdigest(), 16) % m
    assert spark.range(1).select(keys.file_name(F.lit(1234567), F.lit("a.png"))).first()[0] == "1234567.png"
    with pytest.raises(ValueError):
        keys.md5_shard(F.lit("a"), 0)


def plain_survivors(dets):
    def cross(a, b):
        return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))

    def area(a):
        return (a[2] - a[0]) * (a[3] - a[1])

    kept = []
    for d in sorted(dets, key=lambda d: -area(d["bbox"]) if len(d["bbox"]) == 4 else 0):
        x, hit = d["bbox"], False
        for k in kept:
            y = k["bbox"]
            if len(x) == len(y) == 4 and (c := cross(x, y)) > 0:
                words = set(d["label"].lower().split()) & set(k["label"].lower().split())
                hit |= c / (area(x) + area(y) - c) > 0.5 or (area(x) > 0 and c / area(x) > 0.8 and bool(words))
        if not hit:
            kept.append(d)
    return [d["idx"] for d in kept]


def test_suppression_equals_plain_code(spark):
    rnd = random.Random(3)
    images = []
    for i in range(60):
        dets = []
        for k in range(rnd.randint(0, 9)):
            x, y = rnd.randint(0, 6) * 10.0, rnd.randint(0, 6) * 10.0
            box = rnd.choice([[x, y, x + rnd.randint(0, 5) * 10, y + rnd.randint(1, 5) * 10]] * 9 + [[], [1.0]])
            dets.append({"label": rnd.choice(["Red  cup", "cup", "dog", "big dog"]), "bbox": [float(v) for v in box], "confidence": 0.5, "depth_value": None, "position": "p", "depth_rank": 0, "area_rank": k, "free_space": "", "idx": k})
        images.append((i, dets))
    df = spark.createDataFrame(images, f"image int, dets {KIND}")
    got = {r.image: [d.idx for d in r.k] for r in df.select("image", g.survivors(F.col("dets"), KIND).alias("k")).collect()}
    assert got == {i: plain_survivors(d) for i, d in images}


def test_scene_text_and_labels(spark):
    assert spark.range(1).select(g.scene_text(F.array().cast(KIND))).first()[0] == "SCENE GRAPH: No objects detected."
    text = "SCENE GRAPH (2 objects detected):\n1. Red Cup [left-near] conf=0.50\n2. dog [x]\n   Clear space"
    assert one(spark, text, responses.known_labels) == ["red cup", "dog"]


def test_responses(spark):
    cases = {"```json\n{1}\n```": "{1}", "```x```": "x", "  plain \n": "plain", "a ```json b``` c ```d```": "b", "``````": ""}
    for raw, want in cases.items():
        assert one(spark, raw, responses.strip_fences) == want
    for raw, want in {"yes": True, "\n YES.": True, "No": False, "YESTERDAY": True, "": False}.items():
        assert one(spark, raw, responses.rejected) is want
    row = json.dumps({"a": None, "b": 5, "c": "x"})
    got = [one(spark, row, lambda c, p=p: responses.json_text(F.try_parse_json(c), f"$.{p}", "gone")) for p in "abcd"]
    assert got == ["None", "5", "x", "gone"]


def test_stage_laws(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "key string, v int")
    done = spark.createDataFrame([(None,), ("a",)], "key string")
    assert [r.key for r in stages.not_done(rows, done, "key").collect()] == ["b"]
    staged = spark.createDataFrame([("a", 9, "n"), (None, 8, "n")], "key string, v int, extra string")
    merged = {r.key: (r.v, r.extra) for r in stages.merged(rows, [staged], "key").collect()}
    assert merged == {None: (8, "n"), "a": (9, "n"), "b": (3, None)}
    again = stages.merged(stages.merged(rows, [staged], "key"), [], "key")
    assert {r.key: (r.v, r.extra) for r in again.collect()} == merged
    parts = [shard_of(spark.range(10).withColumnRenamed("id", "idx"), i, 3).count() for i in range(3)]
    assert sum(parts) == 10
    assert stages.valid_counts(spark.range(3)).first().valid == 3


def test_backend_errors_are_a_column(spark):
    class Upper:
        def call(self, image, prompt):
            if prompt == "bad":
                raise RuntimeError("no")
            return prompt.upper() + image.decode()

    rows = spark.createDataFrame([("bad", "old", bytearray(b"1")), ("ok", "old", bytearray(b"2")), (None, "old", None)], "p string, Answer string, i binary")
    got = {r.p: (r.answer, r.answer_error) for r in backends.answered(rows, {"answer": "p"}, Upper, "i").collect()}
    assert got == {"bad": (None, "RuntimeError: no"), "ok": ("OK2", None), None: (None, None)}


def test_sources_and_stream(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"caption": "x", "url": "u.png"}, {"caption": "y", "url": "v"}], indent=1))
    assert [(r.idx, r.url) for r in annotation_array(spark, str(tmp_path / "a.json")).collect()] == [(0, "u.png"), (1, "v")]
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"idx": i, "caption": "c", "url": "u.png"}))
        ingest(spark, str(tmp_path / "in"), lambda r: r.withColumn("filename", keys.file_name(F.col("idx"), F.col("url"))), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert sorted(r.filename for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["000000.png", "000001.png"]


def test_crop_verdict_and_order(spark):
    kind = "struct<appearance:string,appearance_confidence:string,state:string,state_confidence:string>"
    verdicts = [
        '{"appearance": null, "appearance_confidence": "medium", "appearance_corrected": true, "state": null, "state_confidence": "odd", "state_corrected": true}',
        '{"appearance": "blue", "appearance_confidence": "odd", "appearance_corrected": true, "state": "off", "state_confidence": "medium", "state_corrected": false}',
        '{"appearance_confidence": null, "state_confidence": null}', "{}", "[1]", "no JSON",
    ]
    rows = spark.createDataFrame([(("red", "high", "on", "high"), v) for v in verdicts], f"o {kind}, v string")
    got = rows.select(semantic.verified(F.col("o"), semantic.response(F.col("v"))).alias("r")).collect()
    same = ("red", "high", "on", "high")
    assert [tuple(x.r) for x in got] == [("red", "medium", None, "medium"), ("blue", "medium", "on", "medium"), same, ("red", "medium", "on", "medium"), same, same]
    objs = spark.createDataFrame([([("B",), ("x",), ("a",), ("b",)], ["a", "b"]), ([("z",), ("a",)], [])], "o array<struct<label:string>>, l array<string>")
    out = objs.select(semantic.in_scene_order(F.col("o"), F.col("l")).alias("r")).collect()
    assert [[o.label for o in x.r] for x in out] == [["a", "B", "b", "x"], ["z", "a"]]
    assert one(spark, " . cat | big dog|car .", semantic.normalised_tags) == "cat . big dog.car"


def plain_geometry(dets, width, height):
    """(depth_rank, area_rank, free sides) of each detection."""
    deep = sorted(range(len(dets)), key=lambda i: (dets[i]["depth_value"] is None, dets[i]["depth_value"] or 0.0, i))
    wide = sorted(range(len(dets)), key=lambda i: (-dets[i]["mask_area"], i))
    out = []
    for i, d in enumerate(dets):
        x1, y1, x2, y2 = d["bbox"]
        sides = {"left": x1 > width / 4, "right": x2 < width - width / 4, "above": y1 > height / 4, "below": y2 < height - height / 4}
        for o in dets:
            a1, b1, a2, b2 = o["bbox"]
            dx, dy = (a1 + a2) / 2 - (x1 + x2) / 2, (b1 + b2) / 2 - (y1 + y2) / 2
            sides["left"] &= not (dx < 0 and abs(dy) < y2 - y1 and a2 > x1 - width / 4)
            sides["right"] &= not (dx > 0 and abs(dy) < y2 - y1 and a1 < x2 + width / 4)
            sides["above"] &= not (dy < 0 and abs(dx) < x2 - x1 and b2 > y1 - height / 4)
            sides["below"] &= not (dy > 0 and abs(dx) < x2 - x1 and b1 < y2 + height / 4)
        out.append((0 if d["depth_value"] is None else deep.index(i) + 1, wide.index(i) + 1, [s for s, clear in sides.items() if clear]))
    return out


def test_geometry_of_many_detections(spark):
    """Orders and edges are worked out once for an image: once for each pair of detections, one image of 500 took minutes."""
    rnd, images = random.Random(5), []
    for n in [*range(9)] * 5 + [500]:
        dets = []
        for _ in range(n):
            x, y, w = rnd.randint(0, 60) * 4.0, rnd.randint(0, 40) * 4.0, rnd.randint(1, 9) * 4.0 / (1 + n // 100)
            dets.append({"label": rnd.choice(["cup", "dog"]), "bbox": [x, y, x + w, y + w], "confidence": 0.5, "depth_value": rnd.choice([None, 0.1, 0.2, 0.5]), "mask_area": float(rnd.randint(1, 5))})
        images.append((len(images), dets))
    df = spark.createDataFrame(images, "image int, dets array<struct<label:string,bbox:array<double>,confidence:double,depth_value:double,mask_area:double>>").repartition(1)
    began = time.time()
    got = {r.image: r.g for r in df.select("image", g.with_geometry(F.col("dets"), F.lit(280.0), F.lit(180.0)).alias("g")).collect()}
    assert time.time() - began < 40
    for i, dets in images:
        text = [f"Clear space {', '.join(s)} of the {d['label']}." if s else f"Limited clear space immediately around the {d['label']}." for d, (_, _, s) in zip(dets, plain_geometry(dets, 280.0, 180.0), strict=True)]
        assert [(d.depth_rank, d.area_rank, d.free_space) for d in got[i]] == [(*p[:2], t) for p, t in zip(plain_geometry(dets, 280.0, 180.0), text, strict=True)], i


def test_rebuilding_suppresses_once(spark):
    """The plan holds the fold of suppression once, however often its result is read."""
    rows = spark.createDataFrame([("a", "old", '[{"label": "cup", "bbox": [0, 0, 9, 9]}]'), ("b", "old", "[{broken"), ("c", "old", "{}"), ("d", "old", None), ("e", "old", "null"), ("f", "old", "[]")], "filename string, scene_graph string, scene_detections string")
    found = scenes.rebuilt(rows)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    got = {r.filename: r.scene_graph for r in found.collect()}
    assert {k for k, v in got.items() if v == "old"} >= {"b", "c", "d", "e"} and got["f"] == "SCENE GRAPH: No objects detected."


class CountingBackend:
    """Says how many calls of its worker wait, are run or are kept."""

    def call(self, image, prompt):
        import gc
        from concurrent.futures import Future

        time.sleep(0.001)
        return str(sum(type(o) is Future for o in gc.get_objects())) if int(prompt) % 500 == 499 else "0"


def test_calls_do_not_pile_up(spark):
    """All calls of an Arrow batch, 10,000 rows, used to wait at once."""
    rows = spark.range(3000).coalesce(1).select("id", F.col("id").cast("string").alias("prompt"))
    got = backends.answered(rows, {"said": "prompt"}, CountingBackend).collect()
    assert [r.id for r in got] == list(range(3000)) and all(r.said_error is None for r in got)
    assert 0 < max(int(r.said) for r in got) <= 2 * backends.ROWS_AT_ONCE
