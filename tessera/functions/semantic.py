"""Semantic responses: parsing and validation against closed vocabularies, crop verdicts, order of objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .responses import CONFIDENCES, json_text, strip, strip_fences, subject_known

#: The closed vocabularies.
PHASES = ("setup", "in_progress", "completed")
AFFORDANCES = ("graspable", "fillable", "openable", "stackable", "pourable", "cuttable", "liftable")
PREDICATES = {
    "spatial": ("left_of", "right_of", "in_front_of", "behind", "above", "below", "beside", "near", "adjacent_to", "facing"),
    "support": ("rests_on", "stacked_on", "mounted_on", "attached_to", "leaning_on", "hanging_from"),
    "containment": ("contains", "inside", "holds", "filled_with", "wrapped_in"),
    "part_whole": ("has_part", "is_part_of", "is_lid_of", "is_handle_of", "belongs_to"),
    "set_membership": ("set_with", "matches", "pairs_with", "grouped_with"),
    "functional_pairing": ("used_with", "placed_for", "positioned_beside", "covers"),
    "proximity_semantic": ("belongs_near", "stored_with"),
    "activity_driven": (
        "being_cut_by", "being_poured_into", "being_stirred_by", "being_grasped_by", "being_lifted_by", "being_placed_on", "being_pushed_by",
        "being_folded", "being_wiped", "being_twisted", "being_opened", "being_closed", "being_flipped", "being_stacked_by",
    ),
    "occlusion": ("occluded_by", "partially_behind", "blocks_view_of"),
    "connectivity": ("connected_to",),
}
ALL_PREDICATES = tuple(p for ps in PREDICATES.values() for p in ps)


def predicate_block() -> str:
    """The vocabulary as lines of a prompt; the header and the width of a kind are fixed values."""
    lines = [f"  {kind + ':':22} {', '.join(ps)}" for kind, ps in PREDICATES.items()]
    return "\n".join(["Relationship predicate vocabulary (use ONLY these predicates):", *lines])


def response(raw: Column) -> Column:
    """The response as a variant; null if it is no JSON (repeated keys count as no JSON)."""
    return F.try_parse_json(strip_fences(raw))


def response_error(raw: Column) -> Column:
    """Why a response fails its row; null if it is usable."""
    v = response(raw)
    out = F.when(v.isNull(), "not JSON")
    for key in ("scene_context", "objects", "relationships"):
        out = out.when(F.variant_get(v, f"$.{key}", "variant").isNull(), f"missing key {key}")
    for key, kind in (("scene_context", "OBJECT%"), ("objects", "ARRAY%"), ("relationships", "ARRAY%")):
        out = out.when(~F.schema_of_variant(F.variant_get(v, f"$.{key}", "variant")).like(kind), f"{key} has the wrong kind")
    return out


def _or_null(v: Column, path: str) -> Column:
    """A text field; missing, null and empty are null."""
    return F.nullif(F.try_variant_get(v, path, "string"), F.lit(""))


def _vocabulary(v: Column, path: str, words: tuple[str, ...], default: str | None) -> Column:
    got = F.try_variant_get(v, path, "string")
    return F.when(got.isin(*words), got).otherwise(F.lit(default))


def scene_context(v: Column) -> Column:
    s = F.variant_get(v, "$.scene_context", "variant")
    return F.struct(
        json_text(s, "$.environment", "unknown").alias("environment"), _or_null(s, "$.apparent_activity").alias("apparent_activity"),
        _vocabulary(s, "$.temporal_phase", PHASES, None).alias("temporal_phase"), _vocabulary(s, "$.confidence", CONFIDENCES, "medium").alias("confidence"),
    )


def objects(v: Column, affordances: tuple[str, ...] = AFFORDANCES) -> Column:
    """The objects that have a label; affordances outside the vocabulary go, repeats stay."""
    found = F.coalesce(F.try_variant_get(v, "$.objects", "array<variant>"), F.array().cast("array<variant>"))

    def one(o: Column) -> Column:
        use = F.coalesce(F.try_variant_get(o, "$.affordances", "array<string>"), F.array().cast("array<string>"))
        return F.struct(
            strip(json_text(o, "$.label", "")).alias("label"), F.nullif(strip(json_text(o, "$.position", "")), F.lit("")).alias("position"),
            _or_null(o, "$.appearance").alias("appearance"), _vocabulary(o, "$.appearance_confidence", CONFIDENCES, "medium").alias("appearance_confidence"),
            _or_null(o, "$.state").alias("state"), _vocabulary(o, "$.state_confidence", CONFIDENCES, "medium").alias("state_confidence"),
            F.filter(use, lambda a: a.isin(*affordances)).alias("affordances"),
        )

    return F.filter(F.transform(found, one), lambda o: o["label"] != "")


def relationships(v: Column, labels: Column) -> Column:
    """Triples with a known predicate and, where there are labels, a known subject; the subject is lower-cased."""
    found = F.coalesce(F.try_variant_get(v, "$.relationships", "array<variant>"), F.array().cast("array<variant>"))

    def one(r: Column) -> Column:
        text = {k: strip(json_text(r, f"$.{k}", "")) for k in ("subject", "predicate", "object", "type", "evidence")}
        sure = _vocabulary(r, "$.confidence", CONFIDENCES, "medium").alias("confidence")
        names = [text[k].alias(k) for k in ("predicate", "object", "type")]
        return F.struct(F.lower(text["subject"]).alias("subject"), *names, sure, text["evidence"].alias("evidence"))

    kept = lambda r: (r["subject"] != "") & (r["object"] != "") & r["predicate"].isin(*ALL_PREDICATES) & subject_known(r["subject"], labels)
    return F.filter(F.transform(found, one), kept)


def in_scene_order(objs: Column, labels: Column) -> Column:
    """Objects in the order of the scene's labels, unknown ones last, stably; as they are without labels."""
    keyed = F.transform(objs, lambda o, i: F.struct(F.coalesce(F.nullif(F.array_position(labels, F.lower(o["label"])), F.lit(0)), F.lit(9999)).alias("k"), i.alias("i"), o.alias("o")))
    ordered = F.array_sort(keyed, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).when(a["i"] < b["i"], -1).otherwise(1))
    return F.when(F.size(labels) == 0, objs).otherwise(F.transform(ordered, lambda x: x["o"]))


def verified(obj: Column, verdict: Column) -> Column:
    """A crop verdict (a variant) merged into an object.

    Appearance is corrected only by a value, a state may be cleared.  A missing
    confidence counts as medium and a valid one always counts; a null or invalid
    one becomes medium with a correction and else changes nothing.  Without a
    verdict, or with one that is no JSON object, the object stays.
    """
    text = lambda name: F.try_variant_get(verdict, f"$.{name}", "string")
    new_look = F.coalesce(F.try_variant_get(verdict, "$.appearance_corrected", "boolean"), F.lit(False)) & text("appearance").isNotNull()
    new_state = F.coalesce(F.try_variant_get(verdict, "$.state_corrected", "boolean"), F.lit(False))

    def sure(name: str, new: Column) -> Column:
        said = F.when(F.variant_get(verdict, f"$.{name}", "variant").isNull(), "medium").otherwise(text(name))
        return F.when(said.isin(*CONFIDENCES), said).when(new, "medium").otherwise(obj[name])

    out = obj
    for name, new in (("appearance", new_look), ("state", new_state)):
        out = out.withField(name, F.when(new, text(name)).otherwise(obj[name])).withField(f"{name}_confidence", sure(f"{name}_confidence", new))
    judged = verdict.isNotNull() & F.schema_of_variant(verdict).like("OBJECT%")
    return F.when(F.coalesce(judged, F.lit(False)), out).otherwise(obj)


def normalised_tags(tags: Column) -> Column:
    """Tags divided by bars become tags divided by full stops."""
    return F.btrim(F.replace(F.replace(tags, F.lit(" | "), F.lit(" . ")), F.lit("|"), F.lit(".")), F.lit(" ."))


#: The columns' JSON: an annotation as stored, with nulls written out.
JSON = {"ignoreNullFields": "false"}


def props_json(context: Column, objs: Column) -> Column:
    return F.to_json(F.struct(context.alias("scene_context"), objs.alias("objects")), JSON)


def rels_json(rels: Column) -> Column:
    return F.to_json(F.struct(rels.alias("relationships")), JSON)


CONTEXT = "scene_context struct<environment:string,apparent_activity:string,temporal_phase:string,confidence:string>"
OBJECT = "struct<label:string,position:string,appearance:string,appearance_confidence:string,state:string,state_confidence:string,affordances:array<string>>"
RELATION = "struct<subject:string,predicate:string,object:string,type:string,confidence:string,evidence:string>"


def merged_json(props: Column, rels: Column, labels: Column) -> Column:
    """Stored properties and relationships as one pretty document, objects in the scene's order; null if either is no JSON."""
    p = F.from_json(props, f"{CONTEXT}, objects array<{OBJECT}>", {"mode": "PERMISSIVE"})
    r = F.from_json(rels, f"relationships array<{RELATION}>")
    both = F.struct(p["scene_context"].alias("scene_context"), in_scene_order(p["objects"], labels).alias("objects"), r["relationships"].alias("relationships"))
    usable = F.try_parse_json(props).isNotNull() & F.try_parse_json(rels).isNotNull()
    return F.when(usable, F.to_json(both, JSON | {"pretty": "true"}))
