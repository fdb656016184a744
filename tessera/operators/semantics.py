"""Semantic annotations: extraction by one call an image, then each object checked on its own crop."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from ..functions import geometry as g
from ..functions import prompts, responses, semantic
from .backends import Backend, answered, message
from .scenes import STORED

Cropper = Callable[[bytes, list[int]], bytes]


def pillow_crop(image: bytes, box: list[int]) -> bytes:
    """The crop as JPEG, by the Pillow library."""
    from PIL import Image

    out = io.BytesIO()
    Image.open(io.BytesIO(image)).convert("RGB").crop(tuple(box)).save(out, format="JPEG", quality=90)
    return out.getvalue()


def largest(detections: str = "scene_detections", n: int = 25) -> F.Column:
    """The JSON of the n largest detections, if there are more; what is no list of ranked detections passes unread."""
    parsed = F.from_json(detections, f"array<{STORED}>")
    many = F.coalesce(F.size(parsed) > n, F.lit(False)) & ~F.exists(parsed, lambda d: d["area_rank"].isNull())
    return F.when(many, F.to_json(g.top(parsed, n), {"ignoreNullFields": "false"})).otherwise(F.col(detections))


def extracted(rows: DataFrame, make: Callable[[], Backend], image: str | None = None, at_once: int = 8) -> DataFrame:
    """rows with context, objects, relations and error, from one call each.

    A failing call, a response that is no JSON or lacks a part fails its row
    only.  Columns of the names made here are replaced.
    """
    cut = rows.drop("context", "objects", "relations", "error").withColumn("scene_detections", largest())
    asked = cut.withColumn("__p", prompts.filled(prompts.SEMANTIC_EXTRACT, scene_graph=F.col("scene_graph"), scene_detections=F.col("scene_detections")))
    said = answered(asked, {"__r": "__p"}, make, image, at_once)
    error = F.coalesce("__r_error", F.when(F.col("__r").isNotNull(), semantic.response_error(F.col("__r"))))
    read = said.withColumn("__e", error).withColumn("__j", F.when(F.col("__e").isNull(), semantic.response(F.col("__r"))))
    labels = responses.known_labels(F.col("scene_graph"))
    v, good = F.col("__j"), F.col("__e").isNull()
    made = {"context": semantic.scene_context(v), "objects": semantic.objects(v), "relations": semantic.relationships(v, labels)}
    return read.withColumns({k: F.when(good, c) for k, c in made.items()}).withColumn("error", F.col("__e")).drop("__p", "__r", "__r_error", "__e", "__j")


def cropped(rows: DataFrame, crop: Cropper, image: str, box: str, out: str = "crop") -> DataFrame:
    """rows with the crop's bytes; null, with a message in `<out>_error`, where it cannot be made."""
    kept = rows.drop(out, f"{out}_error")
    schema = StructType([*kept.schema.fields, StructField(out, BinaryType()), StructField(f"{out}_error", StringType())])
    at, box_at = kept.columns.index(image), kept.columns.index(box)

    def one(data: bytes | None, b: list[int] | None) -> tuple[bytes | None, str | None]:
        if b is None:
            return None, None
        try:
            return crop(data or b"", b), None
        except Exception as e:  # recorded: a raise would fail the job
            return None, message(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [one(x, y) for x, y in zip(b.column(at).to_pylist(), b.column(box_at).to_pylist(), strict=True)]
            cols = list(zip(*got, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)


def verified_objects(rows: DataFrame, key: str, make: Callable[[], Backend], crop: Cropper = pillow_crop, image: str = "image", at_once: int = 8) -> DataFrame:
    """rows (key, objects, scene_detections, width, height, image) with each object checked on the crop of its detection.

    The detection is the last one with the object's label and position, else the
    nearest with the label.  Objects without one, with a crop too small, or with
    a failing call or verdict stay as they are, each by itself.  key is unique.
    """
    dets = F.from_json("scene_detections", f"array<{STORED}>")
    one = rows.select(key, image, dets.alias("dets"), F.col("width").cast("double").alias("w"), F.col("height").cast("double").alias("h"), F.posexplode("objects").alias("place", "obj"))
    det = g.detection_for(F.col("dets"), F.col("obj.label"), F.col("obj.position"))
    one = one.withColumn("box", det["bbox"]).drop("dets")
    box = g.crop_box(F.col("box"), F.col("w"), F.col("h"))
    one = one.withColumn("cut", F.when(F.size("box") >= 4, box)).withColumn("cut", F.when(g.crop_kept(F.col("cut"), F.col("w"), F.col("h")), F.col("cut")))
    ask = prompts.filled(prompts.SEMANTIC_VERIFY_OBJECT, label=F.col("obj.label"), appearance=F.coalesce("obj.appearance", F.lit("unknown")), state=F.coalesce("obj.state", F.lit("unknown")))
    one = cropped(one, crop, image, "cut").drop(image).withColumn("ask", F.when(F.col("crop").isNotNull(), ask))
    said = answered(one, {"verdict": "ask"}, make, "crop", at_once)
    new = said.withColumn("obj", semantic.verified(F.col("obj"), semantic.response(F.col("verdict"))))
    lists = new.groupBy(F.col(key).alias("__key")).agg(F.sort_array(F.collect_list(F.struct("place", "obj"))).alias("__objects"))
    out = rows.join(lists, F.col(key).eqNullSafe(F.col("__key")), "left")
    fixed = F.coalesce(F.transform("__objects", lambda x: x["obj"]), F.col("objects"))
    return out.withColumn("objects", fixed).drop("__key", "__objects")


def annotation_columns(rows: DataFrame, key: str = "filename") -> DataFrame:
    """(key, semantic_props, semantic_rels) of the rows without an error."""
    good = rows.where(F.col("error").isNull())
    return good.select(key, semantic.props_json(F.col("context"), F.col("objects")).alias("semantic_props"), semantic.rels_json(F.col("relations")).alias("semantic_rels"))
