"""The captioning pipelines: prompts, calls, verification, and what a failure does in each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prompts, responses, semantic
from .backends import Backend, answered
from .stages import done_keys, first_rows, joined, not_done, replaced


@dataclass(frozen=True)
class Pipeline:
    """captions: column to template.  strict: a failing call fails the row; otherwise that caption is null."""

    captions: dict[str, str]
    verify: str | None = prompts.VERIFY
    strict: bool = False
    needs: tuple[str, ...] = ()


#: The pipelines' names, their columns and the tables they need.
PIPELINES = {
    "relabel": Pipeline({"new_caption": ""}, verify=None, strict=True),
    "two-call": Pipeline({"spatial_caption": prompts.TWO_CALL_GENERATE}, strict=True),
    "robotic": Pipeline({"type_a": prompts.TYPE_A, "type_b": prompts.TYPE_B, "type_c": prompts.TYPE_C}),
    "scene-graph": Pipeline({"scene_type_a": prompts.SCENE_TYPE_A, "scene_type_b": prompts.SCENE_TYPE_B, "scene_type_c": prompts.SCENE_TYPE_C}, needs=("scene_graphs",)),
    "semantic": Pipeline({"semantic_caption": prompts.SEMANTIC_CAPTION}, verify=prompts.SEMANTIC_VERIFY, needs=("scene_graphs", "semantic_annotations")),
}


def prompt_of(name: str, template: str, prompt: str) -> Column:
    """A caption's prompt; null where there is nothing to ask."""
    if name == "new_caption":
        return F.lit(prompt)
    if name == "semantic_caption":
        known = semantic.merged_json(F.col("semantic_props"), F.col("semantic_rels"), responses.known_labels(F.col("scene_graph")))
        return F.when(known.isNotNull(), prompts.filled(template, scene_graph=F.col("scene_graph"), semantic_annotation=known))
    values = {"original_caption": F.col("caption")} | ({"scene_graph": F.col("scene_graph")} if "{scene_graph}" in template else {})
    return prompts.filled(template, **values)


def annotated(rows: DataFrame, pipeline: str, make: Callable[[], Backend], image: str | None = None, verify: bool = True, prompt: str = "Describe this image in one concise sentence.", at_once: int = 8) -> DataFrame:
    """rows with the pipeline's caption columns and `error`, which is null unless the row fails.

    A verifier that says YES clears a caption.  Where a call or a verification
    fails, strict pipelines fail the row; in the others a failed call leaves the
    caption null and a failed verification leaves it standing.  A semantic
    caption is trimmed, and null if it is empty or its annotations are no JSON.
    Columns of the names made here are replaced.
    """
    if pipeline not in PIPELINES:
        raise ValueError(f"unknown pipeline {pipeline!r}; known: {sorted(PIPELINES)}")
    plan = PIPELINES[pipeline]
    names = list(plan.captions)
    out = rows.withColumns({f"__p_{n}": prompt_of(n, t, prompt) for n, t in plan.captions.items()})
    out = answered(out, {n: f"__p_{n}" for n in names}, make, image, at_once).drop(*[f"__p_{n}" for n in names])  # the next call's workers need no old prompts
    if pipeline == "semantic":
        out = out.withColumns({n: F.nullif(responses.strip(F.col(n)), F.lit("")) for n in names})
    failed = [F.col(f"{n}_error") for n in names]
    if verify and plan.verify:
        asked = {n: F.when(F.col(n).isNotNull(), prompts.filled(plan.verify, caption=F.col(n))) for n in names}
        out = answered(out.withColumns({f"__v_{n}": c for n, c in asked.items()}), {f"__s_{n}": f"__v_{n}" for n in names}, make, image, at_once)
        wrong = {n: F.coalesce(responses.rejected(F.col(f"__s_{n}")), F.lit(False)) for n in names}
        failed += [F.col(f"__s_{n}_error") for n in names]
        out = out.withColumns({n: F.when(~wrong[n], F.col(n)) for n in names})
    error = F.coalesce(*failed) if plan.strict else F.lit(None).cast("string")
    helpers = [c for c in out.columns if c.startswith(("__v_", "__s_")) or c in {f"{n}_error" for n in names}]
    return out.withColumn("__error", error).drop(*helpers, "error").withColumnRenamed("__error", "error")


def prerequisites(metadata: DataFrame, pipeline: str, scene_graphs: DataFrame | None = None, semantic_annotations: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """metadata joined to the tables that the pipeline needs, and for each a row with how many rows had no partner."""
    out, dropped = metadata, {}
    for name in PIPELINES[pipeline].needs:
        table, cols = {"scene_graphs": (scene_graphs, ["scene_graph"]), "semantic_annotations": (semantic_annotations, ["semantic_props", "semantic_rels"])}[name]
        if table is None:
            raise FileNotFoundError(f"the {pipeline} pipeline needs the {name} table")
        out, dropped[name] = joined(out, table, "filename", *cols)
    return out, dropped


def pending(rows: DataFrame, existing: DataFrame | None, overwrite: bool = False, limit: int | None = None, order: str = "filename") -> DataFrame:
    """The rows to caption: the first `limit`, then those that are not there yet, or all of them if they overwrite."""
    some = first_rows(rows, order, limit)
    done = done_keys("filename", None if overwrite else existing)
    return some if done is None else not_done(some, done, "filename")


def merged_results(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """New rows replace existing ones of the same file whole."""
    return new if existing is None else replaced(existing, new, "filename")
