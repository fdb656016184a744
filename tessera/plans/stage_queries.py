"""Registered queries of whole stages: merge, fetch, captions, verdicts and reports, each beside its SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import geometry as g
from ..functions import prompts, semantic
from ..functions.keys import file_name, md5_shard
from ..operators import annotators, backends, scenes, stages, store
from ..sources import images
from . import detections as d
from .catalog import _DET, _KEPT, _SIDES, ORACLE_SQL, query, table


@query("merge_roundtrip", """
SELECT doc_id || '.jpg' AS filename, lang, n_chars, -1 AS quality FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL SELECT doc_id || '.jpg', NULL, NULL, CASE WHEN doc_id % 7 = 0 THEN quality + 10 ELSE quality END FROM labels
""")
def merge_roundtrip(spark, sf):
    """A canonical table, three shards of a run and a later run, all written, merged and read back; rows are replaced whole."""
    folder = store.scratch(spark, "merge")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".jpg")).alias("filename")
    store.append(table(spark, sf, "documents").select(name, "lang", "n_chars", F.lit(-1).alias("quality")), store.canonical(folder, "scene_graphs"))
    labels = table(spark, sf, "labels").select(name, "quality", "doc_id")
    for shard in range(3):
        store.append(labels.where(md5_shard(F.col("filename"), 3) == shard).drop("doc_id"), store.Staged(folder, "scene_graphs", shard, 3, 100 + shard).path)
    store.append(labels.where("doc_id % 7 = 0").select("filename", (F.col("quality") + 10).alias("quality")), store.Staged(folder, "scene_graphs", 0, 1, 900).path)
    store.merge_stage(spark, folder, "scene_graphs")
    return store.read_table(spark, store.canonical(folder, "scene_graphs"))


_FETCHED = """
SELECT *, CASE WHEN error IS NOT NULL THEN NULL WHEN load_error IS NOT NULL THEN 'load_error: ' || load_error
  WHEN width * height < 4096 THEN 'too_small: ' || width || '×' || height || '=' || width * height || ' px (min 4096)' END AS filter_reason
FROM (
  SELECT page_id,
    CASE substr(h, 1, 1) WHEN '0' THEN 'Timeout' WHEN '1' THEN 'HTTP 404' WHEN '2' THEN 'RequestError(ConnectionResetError)' END AS error,
    CASE WHEN substr(h, 1, 1) = '3' THEN 'cannot identify image file' END AS load_error,
    CASE WHEN substr(h, 1, 1) IN ('0', '1', '2', '3') THEN 0 ELSE ('0x' || substr(h, 3, 2))::INTEGER + 1 END AS width,
    CASE WHEN substr(h, 1, 1) IN ('0', '1', '2', '3') THEN 0 ELSE ('0x' || substr(h, 5, 2))::INTEGER + 1 END AS height,
    CASE WHEN substr(h, 1, 1) IN ('0', '1', '2', '3') THEN '' ELSE 'RGB' END AS mode
  FROM (SELECT page_id, md5(url) AS h FROM pages))
"""


@query("fetch_stage", _FETCHED)
def fetch_stage(spark, sf):
    """Fetch, error classes, sizes from headers, and the reasons of the download stage."""
    rows = table(spark, sf, "pages").select("page_id", "url", file_name(F.col("page_id"), F.col("url")).alias("filename"))
    got = images.fetched(rows, "url", "filename", images.fake_fetch)
    reason = F.when(F.col("error").isNull(), stages.download_reason(F.col("load_error"), F.col("width"), F.col("height")))
    return got.withColumn("filter_reason", reason).drop("url", "filename")


@query("download_errors", f"SELECT error AS error_class, count(*) AS n FROM ({_FETCHED}) WHERE error IS NOT NULL GROUP BY error ORDER BY error")
def download_errors(spark, sf):
    return stages.error_counts(fetch_stage(spark, sf))


@query("download_stats", f"""
SELECT count(*) AS total, count_if(error IS NULL AND filter_reason IS NULL) AS success, count_if(error IS NULL AND filter_reason IS NOT NULL) AS invalid,
  count_if(error IS NOT NULL) AS failed, (SELECT count(*) FROM labels) AS skipped FROM ({_FETCHED})
""")
def download_stats(spark, sf):
    done = table(spark, sf, "labels").count()
    return stages.download_stats(fetch_stage(spark, sf).withColumn("valid", F.col("filter_reason").isNull()), done)


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_prompt(template: str, **values: str) -> str:
    """A template as an SQL expression."""
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        parts += [sql_text(text)] if text else []
        parts += [values[name]] if name is not None else []
    return " || ".join(parts)


_GRAPH = "'1. ' || source || ' [left]' || chr(10) || '2. ' || lang || ' [right]'"
_OLD = "lang || ' ' || source"


def _captions_sql(captions: dict[str, str], verify: str, strict: bool, strip: bool = False) -> str:
    """Captions by the stand-in's rules: digest of image and prompt, then of image and the verifier's prompt."""
    first = ", ".join(f"md5(lang || {p}) AS d_{n}" for n, p in captions.items())
    empty = "NULL" if strip else "' ' || chr(10)"
    full = lambda n: f"d_{n}" if strip else f"' ' || d_{n} || chr(10)"
    said = lambda n: f"CASE WHEN substr(d_{n}, 2, 1) IN ('0', '1') THEN NULL WHEN substr(d_{n}, 3, 1) = '0' THEN {empty} ELSE {full(n)} END"
    second = ", ".join(f"{said(n)} AS c_{n}" for n in captions)
    third = ", ".join(f"md5(lang || {sql_prompt(verify, caption=f'c_{n}')}) AS v_{n}" for n in captions)
    wrong = lambda n: f"substr(v_{n}, 2, 1) NOT IN ('0', '1') AND substr(v_{n}, 1, 1) IN ('0', '1', '2', '3', '4')"
    out = ", ".join(f"CASE WHEN {wrong(n)} THEN NULL ELSE c_{n} END AS {n}" for n in captions)
    failed = " OR ".join(f"c_{n} IS NULL OR substr(v_{n}, 2, 1) IN ('0', '1')" for n in captions) if strict else "false"
    return f"""
    WITH asked AS (SELECT doc_id, lang, {first} FROM documents), answered AS (SELECT *, {second} FROM asked), checked AS (SELECT *, {third} FROM answered)
    SELECT doc_id, {out}, {failed} AS failed FROM checked
    """


def _captioned(spark, sf, pipeline: str) -> DataFrame:
    """Documents as images: the language's letters are the image, language and source its caption."""
    graph = F.concat(F.lit("1. "), "source", F.lit(" [left]\n2. "), "lang", F.lit(" [right]"))
    context = '{"scene_context": {"environment": "room", "apparent_activity": null, "temporal_phase": null, "confidence": "high"}, "objects": [{"label": "'
    one = '", "position": null, "appearance": null, "appearance_confidence": "high", "state": null, "state_confidence": "medium", "affordances": []}'
    props = F.concat(F.lit(context), F.upper("lang"), F.lit(one + ', {"label": "'), "source", F.lit(one + "]}"))
    rows = table(spark, sf, "documents").select(
        "doc_id", "lang", F.concat_ws(" ", "lang", "source").alias("caption"), graph.alias("scene_graph"),
        F.when(F.col("doc_id") % 9 == 0, "{broken").otherwise(props).alias("semantic_props"), F.lit('{"relationships": []}').alias("semantic_rels"),
        F.col("lang").cast("binary").alias("image"),
    )
    found = annotators.annotated(rows, pipeline, backends.get_backend(Config(vlm_backend="moody")), "image")
    return found.select("doc_id", *annotators.PIPELINES[pipeline].captions, F.col("error").isNotNull().alias("failed"))


@query("annotate_relabel", f"""
SELECT doc_id, CASE WHEN substr(h, 2, 1) IN ('0', '1') THEN NULL WHEN substr(h, 3, 1) = '0' THEN ' ' || chr(10) ELSE ' ' || h || chr(10) END AS new_caption,
  substr(h, 2, 1) IN ('0', '1') AS failed FROM (SELECT doc_id, md5(lang || {sql_text(Config().vlm_prompt)}) AS h FROM documents)
""")
def annotate_relabel(spark, sf):
    return _captioned(spark, sf, "relabel")


@query("annotate_two_call", _captions_sql({"spatial_caption": sql_prompt(prompts.TWO_CALL_GENERATE, original_caption=_OLD)}, prompts.VERIFY, strict=True))
def annotate_two_call(spark, sf):
    return _captioned(spark, sf, "two-call")


@query("annotate_robotic", _captions_sql({n: sql_prompt(t, original_caption=_OLD) for n, t in annotators.PIPELINES["robotic"].captions.items()}, prompts.VERIFY, strict=False))
def annotate_robotic(spark, sf):
    return _captioned(spark, sf, "robotic")


@query("annotate_scene", _captions_sql({n: sql_prompt(t, original_caption=_OLD, scene_graph=_GRAPH) for n, t in annotators.PIPELINES["scene-graph"].captions.items()}, prompts.VERIFY, strict=False))
def annotate_scene(spark, sf):
    return _captioned(spark, sf, "scene-graph")


def _pretty_object(label: str) -> str:
    return f"""'{{
    "label" : "' || {label} || '",
    "position" : null,
    "appearance" : null,
    "appearance_confidence" : "high",
    "state" : null,
    "state_confidence" : "medium",
    "affordances" : [ ]
  }}'"""


_PRETTY = f"""'{{
  "scene_context" : {{
    "environment" : "room",
    "apparent_activity" : null,
    "temporal_phase" : null,
    "confidence" : "high"
  }},
  "objects" : [ ' || {_pretty_object('source')} || ', ' || {_pretty_object('upper(lang)')} || ' ],
  "relationships" : [ ]
}}'"""


_SEMANTIC = f"CASE WHEN doc_id % 9 <> 0 THEN {sql_prompt(prompts.SEMANTIC_CAPTION, scene_graph=_GRAPH, semantic_annotation=_PRETTY)} END"


@query("annotate_semantic", _captions_sql({"semantic_caption": _SEMANTIC}, prompts.SEMANTIC_VERIFY, strict=False, strip=True))
def annotate_semantic(spark, sf):
    """Objects in the order of the scene's lines; every ninth annotation is no JSON."""
    return _captioned(spark, sf, "semantic")


@query("crop_verdicts", """
SELECT doc_id,
  CASE WHEN k IN (1, 5) THEN 'new' ELSE 'old' END AS appearance, CASE k WHEN 0 THEN 'low' WHEN 1 THEN 'high' WHEN 2 THEN 'low' WHEN 5 THEN 'medium' ELSE 'medium' END AS appearance_confidence,
  CASE WHEN k IN (2, 6) THEN NULL WHEN k = 1 THEN 'open' ELSE 'shut' END AS state, CASE k WHEN 0 THEN 'low' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' WHEN 4 THEN 'low' ELSE 'medium' END AS state_confidence
FROM (SELECT doc_id, doc_id % 7 AS k FROM documents)
""")
def crop_verdicts(spark, sf):
    """Corrections, clearings, missing, null and invalid confidences, and a verdict that is no JSON."""
    verdicts = [
        "not JSON",
        '{"appearance": "new", "appearance_corrected": true, "appearance_confidence": "high", "state": "open", "state_corrected": true, "state_confidence": "high"}',
        '{"appearance": null, "appearance_corrected": true, "appearance_confidence": null, "state": null, "state_corrected": true, "state_confidence": "sure"}',
        '{"appearance": "new", "appearance_corrected": false, "state_confidence": "high"}',
        '```json\n{"appearance_confidence": "medium", "state_confidence": null}\n```',
        '{"appearance": "new", "appearance_corrected": true}',
        '{"state_corrected": true}',
    ]
    obj = F.struct(F.lit("old").alias("appearance"), F.lit("low").alias("appearance_confidence"), F.lit("shut").alias("state"), F.lit("low").alias("state_confidence"))
    said = F.get(F.array(*map(F.lit, verdicts)), (F.col("doc_id") % 7).cast("int"))
    rows = table(spark, sf, "documents").select("doc_id", obj.alias("obj"), semantic.response(said).alias("v"))
    return rows.select("doc_id", semantic.verified(F.col("obj"), F.col("v")).alias("o")).select("doc_id", "o.*")


@query("rebuild_scene_graphs", f"""
SELECT image, CASE WHEN image % 5 = 0 THEN 'old text' ELSE scene_graph END AS scene_graph FROM ({ORACLE_SQL['scene_graph_text']})
""")
def rebuild_scene_graphs(spark, sf):
    """Stored detections to text; where they are no JSON the old text stays."""
    found = d.images(d.boxes(spark, sf))
    stored = F.transform("dets", lambda x: x.dropFields("idx").withField("depth_value", g.rounded(x["depth_value"])))
    rows = found.select("image", F.lit("old text").alias("scene_graph"), F.when(F.col("image") % 5 == 0, "[{broken").otherwise(F.to_json(stored)).alias("scene_detections"))
    return scenes.rebuilt(rows).select("image", "scene_graph")


@query("scene_stage", _DET + _KEPT + _SIDES + """
, text AS (SELECT image, 'SCENE GRAPH (' || count(*) || ' objects detected):' || chr(10) || string_agg(
  place || '. ' || label || ' [' || position || '] conf=' || printf('%.2f', confidence) || ' depth=' || coalesce(printf('%.3f', depth), 'n/a')
  || ' depth_rank=' || depth_rank || ' area_rank=' || area_rank || chr(10) || '   ' || free_space, chr(10) ORDER BY place) AS scene_graph, count(*) AS n_objects
FROM (
  SELECT *, row_number() OVER (PARTITION BY image ORDER BY CASE WHEN depth_rank = 0 THEN 9999 ELSE depth_rank END, (x2 - x1) * (y2 - y1) DESC, idx) AS place
  FROM ranked JOIN kept USING (image, idx) JOIN free USING (image, idx)) GROUP BY image)
SELECT image, scene_graph, n_objects, n_objects >= 2 AS valid, CASE WHEN n_objects < 2 THEN 'too_few_objects: ' || n_objects || ' detected (threshold 2)' END AS filter_reason FROM text
""")
def scene_stage(spark, sf):
    """What a model found in each image to the columns of a scene-graph table; ranks are worked out in the image's array."""
    found = d.lists(d.boxes(spark, sf), "label", "bbox", "confidence", "depth_value", "mask_area")
    raw = F.transform("dets", lambda x: x.dropFields("idx")).cast(f"array<{scenes.FOUND}>")
    rows = found.select("image", F.lit(int(d.WIDTH)).alias("width"), F.lit(int(d.HEIGHT)).alias("height"), raw.alias("found"))
    return scenes.scene_columns(rows, keys=("image",)).drop("scene_detections")


@query("report_sections", """
SELECT doc_id, place, section, text FROM (
  SELECT doc_id, 0 AS place, 'caption' AS section, lang AS text FROM documents WHERE doc_id % 3 <> 0
  UNION ALL SELECT doc_id, 1, 'type_a', source FROM documents
  UNION ALL SELECT doc_id, 2, 'semantic_caption', n_chars::VARCHAR FROM documents WHERE n_chars > 500)
""")
def report_sections(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("semantic_caption"), F.col("source").alias("type_a"),
        F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("caption"),
    )
    return stages.sections(rows, "doc_id")


@query("clamped_boxes", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(0.0, least((cx - w / 2) * 280, 280.0)) AS x1, greatest(0.0, least((cy - h / 2) * 180, 180.0)) AS y1,
  greatest(0.0, least((cx + w / 2) * 280, 280.0)) AS x2, greatest(0.0, least((cy + h / 2) * 180, 180.0)) AS y2
FROM (SELECT *, (l_partkey % 9) / 8.0::DOUBLE AS cx, (l_suppkey % 5) / 4.0::DOUBLE AS cy, l_quantity / 64 AS w, l_quantity / 128 AS h FROM lineitem)
""")
def clamped_boxes(spark, sf):
    rows = table(spark, sf, "lineitem")
    cx, cy = (F.col("l_partkey") % 9) / 8.0, (F.col("l_suppkey") % 5) / 4.0
    box = g.clamped_box(cx, cy, F.col("l_quantity") / 64, F.col("l_quantity") / 128, F.lit(d.WIDTH), F.lit(d.HEIGHT))
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", box.alias("b"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.get("b", F.lit(i)).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


@query("tag_lists", "SELECT doc_id, lang || ' . ' || source || '.' || lang AS tags FROM documents")
def tag_lists(spark, sf):
    raw = F.concat(F.lit(" . "), "lang", F.lit(" | "), "source", F.lit("|"), "lang", F.lit(" |"))
    return table(spark, sf, "documents").select("doc_id", semantic.normalised_tags(raw).alias("tags"))


@query("rounded_values", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('%.4f', l_quantity / 51)::DOUBLE AS confidence, printf('%.4f', l_quantity / 32)::DOUBLE AS tie FROM lineitem")
def rounded_values(spark, sf):
    """Four digits of the exact binary value, ties to even."""
    rows = table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", g.rounded(F.col("l_quantity") / 51).alias("confidence"), g.rounded(F.col("l_quantity") / 32).alias("tie"))


@query("mask_medians", """
SELECT vec_id, median(x) AS depth FROM (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings)
WHERE label % 4 = 0 OR i % 3 = label % 3 GROUP BY vec_id
""")
def mask_medians(spark, sf):
    """The median inside a mask; every fourth label has an empty mask, so the whole map counts."""
    mask = F.transform("embedding", lambda x, i: (F.col("label") % 4 != 0) & (i % 3 == F.col("label") % 3))
    values = F.col("embedding").cast("array<double>")
    return table(spark, sf, "embeddings").select("vec_id", g.median_in(values, mask).alias("depth"))


@query("object_order", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'zebra,' || source || ',' || lang || ',' || source ELSE lang || ',' || source || ',' || source || ',zebra' END AS labels FROM documents")
def object_order(spark, sf):
    """Objects in the order of a scene's labels, unknown ones last; as they are without labels."""
    named = lambda c: F.struct(c.alias("label"))
    objs = F.array(named(F.lit("zebra")), named(F.col("source")), named(F.col("lang")), named(F.col("source")))
    labels = F.when(F.col("doc_id") % 4 != 0, F.array("lang", "source")).otherwise(F.array().cast("array<string>"))
    out = semantic.in_scene_order(objs, labels)
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.transform(out, lambda o: o["label"]), ",").alias("labels"))


@query("valid_only", "SELECT doc_id, true AS valid FROM labels WHERE quality = 1")
def valid_only(spark, sf):
    flag = F.when(F.col("doc_id") % 6 != 0, F.col("quality") == 1).otherwise(F.when(F.col("quality") == 1, True))
    return stages.valid_rows(table(spark, sf, "labels").select("doc_id", flag.alias("valid")))
