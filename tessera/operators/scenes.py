"""Scene graphs: detections from a model in Arrow batches, all geometry and text as expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import geometry as g
from .backends import message
from .stages import complexity_reason, kept_on_error

#: One detection as a model gives it, and as a scene-graph table stores it.
FOUND = "struct<label:string,bbox:array<double>,confidence:double,depth_value:double,mask_area:double>"
STORED = "struct<label:string,bbox:array<double>,confidence:double,depth_value:double,position:string,depth_rank:int,area_rank:int,free_space:string>"


class SceneModel(Protocol):
    """Finds objects: (width, height, detections with label, bbox, confidence, depth_value and mask_area)."""

    def extract(self, image: bytes) -> tuple[int, int, list[dict]]: ...


class ComposedModel:
    """Detector and depth estimator as one model; without detections the depth is not estimated.

    detect: image -> (width, height, [(label, bbox, confidence, mask or None)]).
    depth: image -> a map of raw values, larger for nearer.  It is scaled to 0 for the
    nearest and 1 for the farthest (all 1 where it is flat); an object's depth is
    the median in its mask, or of the whole map without one.
    """

    def __init__(self, detect: Callable, depth: Callable[[bytes], np.ndarray]):
        self.detect, self.depth = detect, depth

    def extract(self, image: bytes) -> tuple[int, int, list[dict]]:
        width, height, found = self.detect(image)
        if not found:
            return width, height, []
        raw = np.asarray(self.depth(image), dtype=np.float32)
        low, high = raw.min(), raw.max()
        near_to_far = 1.0 - ((raw - low) / (high - low) if high > low else np.zeros_like(raw))
        out = []
        for label, bbox, confidence, mask in found:
            inside = near_to_far[mask] if mask is not None and mask.any() else near_to_far
            area = float(mask.sum()) if mask is not None else (bbox[2] - bbox[0]) * (bbox[3] - bbox[1])
            out.append({"label": label, "bbox": [float(v) for v in bbox], "confidence": float(confidence), "depth_value": float(np.median(inside)), "mask_area": float(area)})
        return width, height, out


def detected(rows: DataFrame, make: Callable[[], SceneModel], image: str = "image", profile: ResourceProfile | None = None) -> DataFrame:
    """rows with width, height, found and error; a row whose extraction fails has an error and fails nothing else."""
    names = ("width", "height", "found", "error")
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in names])
    spark = rows.sparkSession
    made = spark.createDataFrame([], f"width int, height int, found array<{FOUND}>").schema
    schema = StructType([*kept.schema.fields, *made.fields, StructField("error", StringType())])
    at = kept.columns.index(image)
    item = pa.list_(pa.struct([("label", pa.string()), ("bbox", pa.list_(pa.float64())), ("confidence", pa.float64()), ("depth_value", pa.float64()), ("mask_area", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()

        def one(data: bytes | None) -> tuple:
            try:
                if data is None:
                    raise FileNotFoundError("no image")
                return *model.extract(data), None
            except Exception as e:  # recorded: a raise would fail the job
                return None, None, None, message(e)

        for b in batches:
            cols = list(zip(*[one(x) for x in b.column(at).to_pylist()], strict=True)) or [[]] * 4
            kinds = [pa.int32(), pa.int32(), item, pa.string()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=schema.names)

    return kept.mapInArrow(run, schema, profile=profile)


def scene_columns(rows: DataFrame, least: int = 2, keys: tuple[str, ...] = ("filename",)) -> DataFrame:
    """Of detected rows: keys, scene_graph, scene_detections (JSON), n_objects, valid and filter_reason.

    All rows stay, those with too few objects as invalid.  The text shows the
    boxes that suppression leaves, with values as the model gave them; the JSON
    holds all detections, confidence and depth rounded to four digits.
    """
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    rows = rows.select(*keys, F.coalesce("found", F.array().cast(f"array<{FOUND}>")).alias("found"), w.alias("w"), h.alias("h"))
    rows = rows.withColumn("dets", g.with_geometry(F.col("found"), F.col("w"), F.col("h"))).withColumn("kept", g.survivors(F.col("dets"), f"array<{STORED}>"))
    stored = F.transform("dets", lambda d: d.withField("confidence", g.rounded(d["confidence"])).withField("depth_value", g.rounded(d["depth_value"])))
    n = F.size("kept")
    return rows.select(
        *keys, g.scene_text(F.col("kept")).alias("scene_graph"), F.to_json(stored, {"ignoreNullFields": "false"}).alias("scene_detections"),
        n.cast("long").alias("n_objects"), (n >= least).alias("valid"), complexity_reason(n, least).alias("filter_reason"),
    )


def rebuilt(rows: DataFrame) -> DataFrame:
    """rows with scene_graph written anew from scene_detections; where those are no detections, the old text stays."""
    parsed = F.from_json("scene_detections", f"array<{STORED}>")
    broken = ~F.coalesce(F.schema_of_variant(F.try_parse_json("scene_detections")).like("ARRAY%"), F.lit(False))
    text = g.scene_text(g.survivors(parsed, f"array<{STORED}>"))
    return rows.withColumn("scene_graph", kept_on_error(text, F.col("scene_graph"), broken))
