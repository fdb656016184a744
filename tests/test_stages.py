"""Stages from table to table: laws of shard, merge and rerun; failing and verifying stand-ins; settings and command line."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import cli, config
from tessera.functions import geometry as g
from tessera.functions import prompts, semantic
from tessera.operators import annotators, backends, scenes, semantics, stages, store
from tessera.operators.resources import gpu_profile
from tessera.plans import runs
from tessera.sources import annotations, images


def png(width, height, rest=b"x" * 600):
    return b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + struct.pack(">II", width, height) + rest


class Scripted:
    """Answers by what the prompt holds."""

    def __init__(self, rules):
        self.rules = rules

    def call(self, image, prompt):
        for part, answer in self.rules:
            if part in prompt:
                if isinstance(answer, Exception):
                    raise answer
                return answer(prompt) if callable(answer) else answer
        return "a caption"


def scripted(*rules):
    return lambda: Scripted(rules)


# ---- store


def test_shards_merged_equal_one_run(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i:06d}.jpg", i, None if i % 5 else "é") for i in range(200)], "filename string, n int, caption string")
    for shards in (1, 3, 7):
        folder = f"file://{tmp_path}/m{shards}"
        store.append(rows.where("n < 40").withColumn("caption", F.lit("old")), store.canonical(folder, "annotated"))
        for i in range(shards):
            store.append(runs.shard_rows(rows, i, shards), store.new_staged(folder, "annotated", i, shards).path)
        assert store.merge_stage(spark, folder, "annotated") == {"before": 40, "after": 200, "staged": shards}
        got = store.read_table(spark, store.canonical(folder, "annotated"))
        assert sorted(map(tuple, got.select(*rows.columns).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
        assert store.merge_stage(spark, folder, "annotated") is None and store.staged_tables(spark, folder, "annotated") == []
        assert store.Storage(spark, folder).names(folder) == ["_staging", "annotated.parquet"]


def test_order_of_staged_tables(spark, tmp_path):
    folder = f"file://{tmp_path}/o"
    for shard, shards, run in ((2, 12, 100), (10, 12, 50), (0, 1, 70)):
        store.append(spark.createDataFrame([("a", run), (None, run)], "filename string, run int"), store.Staged(folder, "scene_graphs", shard, shards, run).path)
    found = store.staged_tables(spark, folder, "scene_graphs")
    last = lambda legacy: {r.filename: r.run for r in store.merged_rows(spark, folder, "scene_graphs", found, legacy).collect()}
    assert last(False) == {"a": 100, None: 100}  # the latest run
    assert last(True) == {"a": 100, None: 100} and [s.shard for s in found] == [0, 10, 2]  # by name: shard10 before shard2
    assert store.staged_tables(spark, folder, "metadata") == [] and [s.run for s in store.staged_tables(spark, folder, "scene_graphs", 10, 12)] == [50]


def test_new_columns_and_no_key(spark, tmp_path):
    folder = f"file://{tmp_path}/c"
    store.append(spark.createDataFrame([("u1", 1)], "source_url string, width int"), store.canonical(folder, "metadata"))
    store.append(spark.createDataFrame([("u2", 2, True)], "source_url string, width int, valid boolean"), store.new_staged(folder, "metadata", 0, 2).path)
    assert store.merge_all(spark, folder) == {"metadata": {"before": 1, "after": 2, "staged": 1}, "scene_graphs": None, "semantic_annotations": None, "annotated": None}
    assert sorted((r.source_url, r.valid) for r in store.read_table(spark, store.canonical(folder, "metadata")).collect()) == [("u1", None), ("u2", True)]


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/t.parquet"
    store.replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="."):
        store.replace_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert store.read_table(spark, path).count() == 3
    store.replace_table(store.read_table(spark, path).where("id > 0"), path)  # the plan reads what it replaces
    assert store.read_table(spark, path).count() == 2 and store.Storage(spark, path).names(f"file://{tmp_path}") == ["t.parquet"]


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("a.jpg", "é", None), ("b.jpg", None, "new")], "filename string, caption string, spatial_caption string")
    n = store.export_array(stages.exported(rows).orderBy("filename"), str(tmp_path / "out.json"))
    want = [{"filename": "a.jpg", "original_caption": "é", "caption": None}, {"filename": "b.jpg", "original_caption": None, "caption": "new"}]
    assert n == 2 and (tmp_path / "out.json").read_text() == json.dumps(want, indent=2, ensure_ascii=False)
    assert store.export_array(rows.limit(0), str(tmp_path / "none.json")) == 0 and json.loads((tmp_path / "none.json").read_text()) == []
    store.export_lines(stages.exported(rows), f"file://{tmp_path}/lines")
    assert sorted(map(json.dumps, want)) == sorted(json.dumps(json.loads(x.value)) for x in spark.read.text(f"file://{tmp_path}/lines").collect())
    with pytest.raises(ValueError, match="no caption column"):
        stages.exported(rows.select("filename"))
    with pytest.raises(ValueError, match="nothing"):
        stages.selected(rows, ["nothing"])


# ---- images and download


def test_sizes_from_headers():
    assert images.image_size(png(70, 80)) == (70, 80)
    assert images.image_size(b"GIF89a" + struct.pack("<HH", 5, 6)) == (5, 6)
    assert images.image_size(b"BM" + b"\0" * 16 + struct.pack("<ii", 7, -8)) == (7, 8)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc2\x00\x11\x08" + struct.pack(">HH", 30, 40) + b"\0" * 20
    assert images.image_size(jpeg) == (40, 30)
    assert images.image_size(b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")) == (100, 50)
    assert images.image_size(b"RIFF\0\0\0\0WEBPVP8L" + b"\0" * 4 + b"\x2f" + (11 | 21 << 14).to_bytes(4, "little")) == (12, 22)
    tiff = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 2) + struct.pack("<HHIHH", 256, 3, 1, 9, 0) + struct.pack("<HHII", 257, 4, 1, 10)
    assert images.image_size(tiff) == (9, 10)
    for bad in (b"", b"<html>", b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff\xd9"):
        with pytest.raises(ValueError):
            images.image_size(bad)


def test_download_resumes_and_audits(spark, tmp_path):
    def fetch(url):
        if "gone" in url:
            raise TimeoutError
        return b"no image" if "page" in url else png(3, 3) if "tiny" in url else png(100, 90)

    cfg = config.Config(output_dir=f"file://{tmp_path}/raw", metadata_path=f"file://{tmp_path}/metadata.parquet", filtered_download_path=f"file://{tmp_path}/filtered.parquet")
    (tmp_path / "raw").mkdir()
    (tmp_path / "a.json").write_text(json.dumps([{"caption": f"c{i}", "url": f"http://x/{k}{i}.png?s=1"} for i, k in enumerate(["ok", "gone", "page", "tiny", "ok", "ok"])]))
    rows = annotations.annotation_array(spark, f"file://{tmp_path}/a.json")
    assert runs.download(cfg, rows, fetch=fetch).first().asDict() == {"total": 6, "success": 3, "invalid": 2, "failed": 1, "skipped": 0}
    table = {r.filename: r for r in store.read_table(spark, cfg.metadata_path).collect()}
    assert sorted(table) == ["000000.png", "000002.png", "000003.png", "000004.png", "000005.png"] and (table["000000.png"].width, table["000000.png"].mode) == (100, "RGB")
    audit = {r.filename: r.filter_reason for r in store.read_table(spark, cfg.filtered_download_path).collect()}
    assert audit == {"000002.png": "load_error: cannot identify image file", "000003.png": "too_small: 3×3=9 px (min 4096)"}
    assert (tmp_path / "raw/000002.png").read_bytes() == b"no image" and sorted(p.name for p in (tmp_path / "raw").iterdir()) == sorted(table)
    # what failed is tried again; invalid images are not
    assert runs.download(cfg, rows, fetch=fetch).first().asDict() == {"total": 1, "success": 0, "invalid": 0, "failed": 1, "skipped": 5}
    assert runs.download(cfg, rows, fetch=lambda u: png(64, 64)).first().asDict()["success"] == 1
    lines = f"file://{tmp_path}/lines"
    annotations.to_lines(rows, lines, 3)
    assert sorted(map(tuple, annotations.annotation_lines(spark, lines).collect())) == sorted(map(tuple, rows.collect()))
    shards = [{r.idx for r in annotations.shard_of(rows, i, 4, 1).collect()} for i in range(4)]
    assert shards == [{0}, {1}, {2}, {3}]


def test_staged_downloads_are_skipped_on_demand(spark, tmp_path):
    cfg = config.Config(output_dir=f"file://{tmp_path}/raw", metadata_path=f"file://{tmp_path}/metadata.parquet", filtered_download_path=f"file://{tmp_path}/f.parquet")
    (tmp_path / "raw").mkdir()
    rows = spark.createDataFrame([(i, "c", f"http://x/{i}.jpg") for i in range(9)], annotations.SCHEMA)
    total = lambda skip: runs.download(cfg, rows, 1, 3, lambda u: png(80, 80), skip).first().asDict()["total"]
    assert [total(False), total(True), total(False)] == [3, 0, 3]
    assert store.merge_stage(spark, f"file://{tmp_path}", "metadata")["after"] == 3


# ---- scenes and semantics


class Boxes:
    def extract(self, image):
        if image.endswith(b"bad"):
            raise RuntimeError("no model")
        n = image[-1] % 4
        return 280, 180, [{"label": f"cup {i}", "bbox": [30.0 * i, 20.0 * i, 30.0 * i + 60, 20.0 * i + 40], "confidence": 0.123456, "depth_value": 0.9 - 0.3 * i if i else None, "mask_area": 5.0 + i} for i in range(n)]


def prepared(spark, tmp_path, n=8):
    cfg = config.Config(**{f"{k}_path": f"file://{tmp_path}/{k}.parquet" for k in ("metadata", "scene_graph", "semantic_annotations", "annotated", "filtered_download", "filtered_scene")}, output_dir=f"file://{tmp_path}/raw", verify=True)
    (tmp_path / "raw").mkdir()
    rows = []
    for i in range(n):
        name = f"{i:06d}.png"
        if i != 5:
            (tmp_path / "raw" / name).write_bytes(png(280, 180, b"x" * 600 + (b"bad" if i == 6 else bytes([i]))))
        rows.append((name, f"caption {i}", f"http://{i}", 280, 180, "RGB", i != 7))
    store.append(spark.createDataFrame(rows, "filename string, caption string, source_url string, width int, height int, mode string, valid boolean"), cfg.metadata_path)
    return cfg


def test_scene_stage(spark, tmp_path):
    cfg = prepared(spark, tmp_path)
    errors = {r.error_class: r.n for r in runs.extract_scene_graphs(cfg, spark, Boxes).collect()}
    assert errors == {"FileNotFoundError": 1, "RuntimeError": 1}
    got = {r.filename: r for r in store.read_table(spark, cfg.scene_graph_path).collect()}
    assert {f: (r.n_objects, r.valid) for f, r in got.items()} == {"000000.png": (0, False), "000001.png": (1, False), "000002.png": (2, True), "000003.png": (3, True), "000004.png": (0, False)}
    assert got["000000.png"].scene_graph == "SCENE GRAPH: No objects detected."
    dets = json.loads(got["000003.png"].scene_detections)
    assert [(d["confidence"], d["depth_rank"], d["area_rank"], d["position"]) for d in dets] == [(0.1235, 0, 3, "left-unknown"), (0.1235, 2, 2, "left-mid"), (0.1235, 1, 1, "left-near")]
    audit = {r.filename: r.filter_reason for r in store.read_table(spark, cfg.filtered_scene_path).collect()}
    assert audit == {"000000.png": "no_objects", "000004.png": "no_objects", "000001.png": "too_few_objects: 1 detected (threshold 2)"}
    assert runs.extract_scene_graphs(cfg, spark, Boxes).count() == 2 and store.read_table(spark, cfg.scene_graph_path).count() == 5


def test_composed_model():
    mask = np.zeros((4, 4), dtype=bool)
    mask[0, :2] = True
    depth = np.arange(16.0).reshape(4, 4)
    model = scenes.ComposedModel(lambda b: (4, 4, [("a", (0, 0, 2, 2), 0.5, mask), ("b", (0, 0, 4, 1), 0.5, None)]), lambda b: depth)
    found = model.extract(b"")[2]
    assert found[0]["depth_value"] == pytest.approx(1 - 0.5 / 15) and found[1]["depth_value"] == pytest.approx(0.5) and [d["mask_area"] for d in found] == [2.0, 4.0]
    flat = scenes.ComposedModel(lambda b: (4, 4, [("a", (0, 0, 2, 2), 0.5, mask)]), lambda b: np.ones((4, 4)))
    assert flat.extract(b"")[2][0]["depth_value"] == 1.0
    none = scenes.ComposedModel(lambda b: (4, 4, []), lambda b: 1 / 0)
    assert none.extract(b"") == (4, 4, [])


RESPONSE = {
    "scene_context": {"environment": "desk", "apparent_activity": "", "temporal_phase": "later", "confidence": "sure"},
    "objects": [{"label": "Cup 0", "position": "left-unknown", "state": "full"}, {"label": "cup 1"}, {"label": "ghost"}],
    "relationships": [{"subject": "CUP 0", "predicate": "near", "object": "Cup 1", "confidence": "high"}, {"subject": "ghost", "predicate": "near", "object": "x"}],
}


def test_semantic_stage(spark, tmp_path):
    cfg = prepared(spark, tmp_path)
    runs.extract_scene_graphs(cfg, spark, Boxes).count()
    asked = []
    make = scripted(
        ("Read properties", lambda p: "```json\n" + json.dumps(RESPONSE) + "```" if "(3 objects" in p else '{"objects": null}'),
        ("This crop shows: Cup 0", json.dumps({"state": None, "state_corrected": True, "appearance": "red", "appearance_corrected": True})),
        ("This crop shows: cup 1", RuntimeError("down")),
    )
    crop = lambda image, box: asked.append(box) or bytes(str(box), "ascii")
    errors = {r.error_class: r.n for r in runs.extract_semantic(cfg, spark, make, crop=crop).collect()}
    assert errors == {"missing key scene_context": 1}
    got = store.read_table(spark, cfg.semantic_annotations_path).collect()
    assert [r.filename for r in got] == ["000003.png"]
    props = json.loads(got[0].semantic_props)
    assert props["scene_context"] == {"environment": "desk", "apparent_activity": None, "temporal_phase": None, "confidence": "medium"}
    assert [(o["label"], o["appearance"], o["state"]) for o in props["objects"]] == [("Cup 0", "red", None), ("cup 1", None, None), ("ghost", None, None)]
    assert json.loads(got[0].semantic_rels)["relationships"] == [{"subject": "cup 0", "predicate": "near", "object": "Cup 1", "type": "", "confidence": "high", "evidence": ""}]
    assert runs.extract_semantic(cfg, spark, make, crop=crop).count() == 1  # only the failed one is asked again


def test_only_long_lists_are_cut(spark):
    d = {"label": "a", "bbox": [0.0, 0.0, 1.0, 1.0], "confidence": 0.5, "depth_value": None, "position": "x", "depth_rank": 0, "free_space": ""}
    many = [{**d, "area_rank": (i * 7) % 30} for i in range(30)]
    rows = spark.createDataFrame([(json.dumps(many),), (json.dumps(many[:25]),), ("{broken",), (json.dumps([{**x, "area_rank": None} for x in many]),)], "scene_detections string")
    cut, same, broken, unranked = (r[0] for r in rows.select(semantics.largest()).collect())
    assert [x["area_rank"] for x in json.loads(cut)] == list(range(25))  # rank 0 counts as it stands
    assert json.loads(same) == many[:25] and broken == "{broken" and len(json.loads(unranked)) == 30


# ---- captions


def captions(spark, pipeline, make, verify=True, rows=None):
    rows = rows or [("a.png", "red {x} cup", "1. cup [left]", '{"scene_context": null, "objects": []}', '{"relationships": []}')]
    found = annotators.annotated(spark.createDataFrame(rows, "filename string, caption string, scene_graph string, semantic_props string, semantic_rels string"), pipeline, make, verify=verify)
    return [{n: r[n] for n in (*annotators.PIPELINES[pipeline].captions, "error")} for r in found.collect()]


@pytest.mark.parametrize("pipeline", ["two-call", "robotic", "scene-graph", "semantic"])
def test_what_failures_do(spark, pipeline):
    names = list(annotators.PIPELINES[pipeline].captions)
    strict = pipeline == "two-call"
    one = lambda *rules, verify=True: captions(spark, pipeline, scripted(*rules), verify)[0]
    assert one(("YES or NO", "no")) == {n: "a caption" for n in names} | {"error": None}
    assert one(("YES or NO", " \n yes, wrong")) == {n: None for n in names} | {"error": None}
    assert one(("YES or NO", "yes"), verify=False)[names[0]] == "a caption"
    got = one(("YES or NO", RuntimeError("down")))
    assert got["error"] == ("RuntimeError: down" if strict else None) and all(got[n] == "a caption" for n in names)
    got = one(("YES or NO", "no"), ("", ValueError("refused")))
    assert got["error"] == ("ValueError: refused" if strict else None) and all(got[n] is None for n in names)


def test_semantic_captions(spark):
    row = ("a.png", "c", "1. cup [left]", '{"scene_context": null, "objects": []}', '{"relationships": []}')
    assert captions(spark, "semantic", scripted(("", "  \n")), rows=[row]) == [{"semantic_caption": None, "error": None}]
    assert captions(spark, "semantic", scripted(("YES or NO", "no"), ("", " text \n")), rows=[row])[0]["semantic_caption"] == "text"
    assert captions(spark, "semantic", scripted(("", 1 / 1)), rows=[(*row[:3], "{broken", row[4])])[0] == {"semantic_caption": None, "error": None}


def test_values_are_not_templates(spark):
    row = spark.range(1).select(prompts.filled("a {x} b {{y}} {z}", x=F.lit("{z}"), z=F.lit(None)).alias("p")).first()
    assert row.p == "a {z} b {y} None"
    for t in (prompts.SEMANTIC_EXTRACT, prompts.SEMANTIC_VERIFY_OBJECT):
        p = spark.range(1).select(prompts.filled(t, scene_graph=F.lit(""), scene_detections=F.lit(""), label=F.lit(""), appearance=F.lit(""), state=F.lit(""))).first()[0]
        assert "{{" not in p and '{"' in p
    block = semantic.predicate_block().split("\n")
    assert block[0].startswith("Relationship predicate vocabulary") and block[1].startswith("  spatial:" + " " * 15 + "left_of, ") and len(block) == 11


def test_annotate_resumes_replaces_and_shards(spark, tmp_path):
    cfg = prepared(spark, tmp_path, 6)
    assert [r.error_class for r in runs.annotate(cfg, spark, "two-call", scripted(("YES or NO", "no"))).collect()] == ["FileNotFoundError"]
    table = lambda: {r.filename: r for r in store.read_table(spark, cfg.annotated_path).collect()}
    assert len(table()) == 5 and "error" not in store.read_table(spark, cfg.annotated_path).columns
    runs.annotate(cfg, spark, "robotic", scripted(("YES or NO", "no"))).count()
    assert len(table()) == 5  # a row that is there is skipped, whatever columns it lacks
    runs.annotate(cfg.but(overwrite=True, annotate_limit=2), spark, "relabel", scripted(("", "new"))).count()
    got = table()
    assert got["000000.png"].new_caption == "new" and got["000000.png"].spatial_caption is None and got["000004.png"].spatial_caption == "a caption"
    fresh = cfg.but(annotated_path=f"file://{tmp_path}/more/annotated.parquet")
    for i in range(3):
        runs.annotate(fresh, spark, "two-call", scripted(("YES or NO", "no")), i, 3).count()
    assert store.merge_stage(spark, f"file://{tmp_path}/more", "annotated")["after"] == 5
    with pytest.raises(FileNotFoundError, match="scene_graphs"):
        runs.annotate(cfg, spark, "semantic", scripted())
    with pytest.raises(ValueError, match="unknown pipeline"):
        annotators.annotated(spark.range(1), "other", scripted())


def test_backends_send_images():
    sent = []
    post = lambda url, body, headers, timeout: sent.append((url, body, headers)) or {"choices": [{"message": {"content": " hi "}}], "candidates": [{"content": {"parts": [{"text": " ho "}]}}]}
    assert backends.ChatBackend("http://h/v1/", "m", "k", post=post).call(b"\xff\xd8", "p") == "hi"
    assert sent[0][0] == "http://h/v1/chat/completions" and sent[0][1]["messages"][0]["content"][0]["image_url"]["url"] == "data:image/jpeg;base64,/9g="
    assert backends.GeminiBackend(config.Config(gemini_api_key="key"), post).call(b"\xff\xd8", "p") == "ho"
    assert sent[1][2] == {"x-goog-api-key": "key"} and sent[1][1]["contents"][0]["parts"][1]["inline_data"]["data"] == "/9g="
    with pytest.raises(ValueError, match="unknown backend"):
        backends.get_backend(config.Config(vlm_backend="other"))
    assert set(backends.BACKENDS) >= {"gemini", "openai", "qwen_local", "vllm"}


# ---- backfill, geometry, settings, command line


def test_backfill(spark, tmp_path):
    cfg = prepared(spark, tmp_path, 4)
    (tmp_path / "raw/000002.png").write_bytes(b"short")
    (tmp_path / "raw/000003.png").write_bytes(png(9, 9))
    old = spark.createDataFrame([("000000.png", 0, 7), ("000001.png", 3, 4), ("000002.png", None, None), ("000003.png", None, None), ("gone.png", None, 0)], "filename string, width int, height int")
    store.replace_table(old, cfg.metadata_path)
    assert runs.backfill(cfg, spark, dry_run=True) == {"needed": 5, "invalid": 3, "missing": 1}
    assert runs.backfill(cfg, spark, limit=1) == {"needed": 1, "invalid": 0, "missing": 0}
    assert runs.backfill(cfg, spark) == {"needed": 4, "invalid": 3, "missing": 1}
    got = {r.filename: (r.width, r.height, r["mode"], r.valid) for r in store.read_table(spark, cfg.metadata_path).collect()}
    assert got == {"000000.png": (280, 7, "RGB", True), "000001.png": (3, 4, "RGB", True), "000002.png": (0, 0, "", False), "000003.png": (9, 9, "RGB", False), "gone.png": (0, 0, "", False)}
    audit = {r.filename: r.filter_reason for r in store.read_table(spark, cfg.filtered_download_path).collect()}
    assert audit == {"000002.png": "file_too_small", "000003.png": "file_too_small" if len(png(9, 9)) < 512 else "too_small", "gone.png": "missing_file"}


def test_crop_is_padded_by_the_image(spark):
    box = lambda *b: F.array(*[F.lit(float(v)) for v in b])
    w, h = F.lit(280.0), F.lit(180.0)
    row = spark.range(1).select(g.crop_box(box(100, 60, 120, 80), w, h).alias("a"), g.crop_box(box(-500, 0, -400, 9), w, h).alias("b")).first()
    assert row.a == [86, 51, 134, 89]
    assert not spark.range(1).select(g.crop_kept(g.crop_box(box(-500, 0, -400, 9), w, h), w, h)).first()[0]


def test_profile_asks_for_accelerators():
    assert gpu_profile(0) is None
    half = gpu_profile(0.5)
    assert half.taskResources["gpu"].amount == 0.5 and half.executorResources["gpu"].amount == 1


def test_settings(tmp_path, monkeypatch):
    toml = tmp_path / "c.toml"
    toml.write_text('timeout = 5\nverify = false\nvlm_model = "m"\nconcurrency = 3\n')
    env = tmp_path / ".env"
    env.write_text("# note\nTESSERA_CONCURRENCY=4\nexport TESSERA_OPENAI_API_KEY='secret'\nTESSERA_DOWNLOAD_LIMIT=\n")
    monkeypatch.setenv("TESSERA_VLM_MODEL", "from the shell")
    monkeypatch.setenv("TESSERA_OVERWRITE", "yes")
    cfg = config.load(str(toml), str(env), timeout=7)
    assert (cfg.timeout, cfg.verify, cfg.vlm_model, cfg.concurrency, cfg.overwrite, cfg.download_limit) == (7, False, "from the shell", 4, True, None)
    assert cfg.openai_api_key == "secret" and "secret" not in repr(cfg) and config.load(None, str(tmp_path / "no")).min_image_pixels == 4096
    toml.write_text("other = 1\n")
    with pytest.raises(ValueError, match="unknown settings"):
        config.load(str(toml), str(env))


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    cfg = prepared(spark, tmp_path)
    (tmp_path / "config.toml").write_text("\n".join(f'{k} = "{getattr(cfg, k)}"' for k in ("metadata_path", "scene_graph_path", "semantic_annotations_path", "annotated_path", "filtered_download_path", "filtered_scene_path", "output_dir")) + '\nvlm_backend = "fake"\n')
    run = lambda *argv: cli.run(spark, list(argv))
    assert run("annotate", "--pipeline", "relabel", "--limit", "3") == []
    assert run("count_scene_graph_rows", cfg.metadata_path) == {"total": 8, "valid": 7, "unknown": 0}
    assert run("export_json", "--input", cfg.annotated_path, "--output", str(tmp_path / "x.json")) == 3
    assert "new_caption" in run("show_parquet", cfg.annotated_path, "--info")["schema"]
    assert run("show_parquet", cfg.annotated_path, "--cols", "filename", "--head", "1").startswith("{'filename'")
    assert run("show_parquet", cfg.annotated_path, "--report", str(tmp_path / "r.md")) == 6 and "## new_caption" in (tmp_path / "r.md").read_text()
    assert run("annotate", "--pipeline", "two-call", "--num-shards", "2", "--shard-id", "0", "--no-verify") in ([], [{"error_class": "FileNotFoundError", "n": 1}])
    assert set(run("merge", "--all", "--data-dir", f"file://{tmp_path}")) == set(store.STAGE_KEYS)
    args = lambda *a: cli.parser().parse_args(list(a))
    both = ("--verify", "--no-verify")
    assert cli.verify_of(args("extract_semantic", *both)) is True and cli.verify_of(args("annotate", *both)) is False
    assert cli.verify_of(args("annotate", "--pipeline", "semantic")) is False and cli.verify_of(args("annotate")) is None
    with pytest.raises(SystemExit):
        args("merge", "--all", "--stage", "metadata")
