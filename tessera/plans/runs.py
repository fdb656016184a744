"""The stages from table to table: what is pending for a shard is worked out, run, and appended or staged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.keys import file_name, md5_shard
from ..operators import annotators, scenes, semantics, stages, store
from ..operators.backends import Backend, get_backend
from ..operators.resources import gpu_profile
from ..sources import images
from ..sources.annotations import shard_of


def _out(spark: SparkSession, path: str, shard: int, shards: int) -> str:
    """Where a shard writes: the table itself, or a staged table beside it."""
    if shards <= 1:
        return path
    folder, _, name = path.rpartition("/")
    return store.new_staged(folder, name.removesuffix(".parquet"), shard, shards).path


def _staged(spark: SparkSession, path: str, shard: int, shards: int) -> list[DataFrame | None]:
    folder, _, name = path.rpartition("/")
    return [store.read_table(spark, s.path) for s in store.staged_tables(spark, folder, name.removesuffix(".parquet"), shard, shards)]


def shard_rows(rows: DataFrame, shard: int, shards: int, key: str = "filename") -> DataFrame:
    return rows if shards <= 1 else rows.where(md5_shard(F.col(key), shards) == shard)


def _needed(spark: SparkSession, path: str, what: str) -> DataFrame:
    table = store.read_table(spark, path)
    if table is None:
        raise FileNotFoundError(f"no {what} at {path}")
    return table


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """Written once, then read: calls and fetches behind rows are not made again."""
    path = store.scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def download(cfg: Config, annotations: DataFrame, shard: int = 0, shards: int = 1, fetch: images.Fetch | None = None, skip_staged: bool = False) -> DataFrame:
    """Fetch the annotations (idx, caption, url) that are not in the metadata yet; returns the statistics.

    The shard is by place in the input, the limit counts in the shard.  A failed
    fetch leaves no row and is tried again in the next run; an invalid image
    leaves one and an audit row.
    """
    spark = annotations.sparkSession
    done = stages.done_keys("source_url", store.read_table(spark, cfg.metadata_path), *(_staged(spark, cfg.metadata_path, shard, shards) if skip_staged and shards > 1 else []))
    mine = shard_of(annotations, shard, shards, cfg.download_limit).select(file_name(F.col("idx"), F.col("url")).alias("filename"), "caption", F.col("url").alias("source_url"))
    todo = mine if done is None else stages.not_done(mine, done, "source_url")
    got = _kept(images.fetched(todo, "source_url", "filename", fetch or images.http_fetch(cfg.timeout), cfg.output_dir), "fetched")
    reason = stages.download_reason(F.col("load_error"), F.col("width"), F.col("height"), cfg.min_image_pixels)
    judged = got.withColumn("filter_reason", reason).withColumn("valid", F.col("filter_reason").isNull())
    rows = judged.where("error is null")
    store.append(rows.select("filename", "caption", "source_url", "width", "height", "mode", "valid"), _out(spark, cfg.metadata_path, shard, shards))
    store.audit(rows, cfg.filtered_download_path)
    return stages.download_stats(judged, 0 if done is None else done.distinct().count())


def extract_scene_graphs(cfg: Config, spark: SparkSession, make: Callable[[], scenes.SceneModel], shard: int = 0, shards: int = 1) -> DataFrame:
    """Scene graphs of valid images that have none yet; returns the counts of errors."""
    rows = stages.valid_rows(_needed(spark, cfg.metadata_path, "metadata")).select("filename")
    todo = shard_rows(annotators.pending(rows, store.read_table(spark, cfg.scene_graph_path), limit=cfg.annotate_limit), shard, shards)
    found = _kept(scenes.detected(images.with_images(todo, cfg.output_dir), make, profile=gpu_profile(cfg.num_gpus_per_worker)).drop("image"), "detections")
    made = scenes.scene_columns(found.where("error is null"), cfg.min_scene_objects)
    store.append(made.drop("filter_reason"), _out(spark, cfg.scene_graph_path, shard, shards))
    store.audit(made, cfg.filtered_scene_path)
    return stages.error_counts(found)


def extract_semantic(cfg: Config, spark: SparkSession, make: Callable[[], Backend] | None = None, shard: int = 0, shards: int = 1, crop: semantics.Cropper = semantics.pillow_crop) -> DataFrame:
    """Semantic annotations of valid scenes that have none yet, staged ones of the shard included; returns the counts of errors."""
    rows = stages.valid_rows(_needed(spark, cfg.scene_graph_path, "scene graphs"))
    done = stages.done_keys("filename", store.read_table(spark, cfg.semantic_annotations_path), *(_staged(spark, cfg.semantic_annotations_path, shard, shards) if shards > 1 else []))
    todo = shard_rows(annotators.pending(rows.select("filename", "scene_graph", "scene_detections"), done, limit=cfg.annotate_limit), shard, shards)
    make = make or get_backend(cfg)
    seen = images.inspected(images.with_images(todo, cfg.output_dir))
    found = semantics.extracted(seen, make, "image", cfg.concurrency).withColumn("error", F.coalesce("error", F.when(~F.col("image_exists"), "FileNotFoundError: no image")))
    found = _kept(found, "semantics")
    if cfg.verify:
        found = _kept(semantics.verified_objects(found, "filename", make, crop, "image", cfg.concurrency), "verified")
    store.append(semantics.annotation_columns(found), _out(spark, cfg.semantic_annotations_path, shard, shards))
    return stages.error_counts(found)


def annotate(cfg: Config, spark: SparkSession, pipeline: str = "robotic", make: Callable[[], Backend] | None = None, shard: int = 0, shards: int = 1) -> DataFrame:
    """Captions of images that have none yet, or of all if they overwrite; returns the counts of errors."""
    tables = {n: store.read_table(spark, p) for n, p in (("scene_graphs", cfg.scene_graph_path), ("semantic_annotations", cfg.semantic_annotations_path))}
    rows, _ = annotators.prerequisites(_needed(spark, cfg.metadata_path, "metadata"), pipeline, **tables)
    existing = store.read_table(spark, cfg.annotated_path)
    todo = shard_rows(annotators.pending(rows, existing, cfg.overwrite, cfg.annotate_limit), shard, shards)
    seen = images.with_images(todo, cfg.output_dir)
    made = annotators.annotated(seen, pipeline, make or get_backend(cfg), "image", cfg.verify, cfg.vlm_prompt, cfg.concurrency)
    made = made.withColumn("error", F.when(~F.col("image_exists"), "FileNotFoundError: no image").otherwise(F.col("error"))).drop("image", "image_exists", "image_bytes")
    made = _kept(made, "captions")
    good = made.where("error is null").drop("error")
    if shards <= 1 and cfg.overwrite:
        store.replace_table(annotators.merged_results(existing, good), cfg.annotated_path)
    else:
        store.append(good, _out(spark, cfg.annotated_path, shard, shards))
    return stages.error_counts(made)


def backfill(cfg: Config, spark: SparkSession, source: str | None = None, target: str | None = None, limit: int | None = None, dry_run: bool = False) -> dict[str, int]:
    """Fill what is missing in metadata from the images; the first `limit` rows that need it, by name.  Returns counts."""
    source = source or cfg.metadata_path
    rows = _needed(spark, source, "metadata")
    kinds = {"width": "int", "height": "int", "mode": "string", "valid": "boolean"}
    need = stages.needs_backfill(rows.columns, **kinds)
    for c, kind in kinds.items():
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit("" if kind == "string" else None).cast(kind))
    rows = rows.withColumn("__need", need)
    todo = stages.first_rows(rows.where("__need").select("filename"), "filename", limit)
    seen = images.inspected(images.with_images(todo, cfg.output_dir))
    reason = stages.validity_reason(F.col("image_exists"), F.col("image_bytes"), F.col("width"), F.col("height"), F.col("load_error"), cfg.min_image_pixels)
    seen = _kept(seen.withColumn("filter_reason", reason).drop("image"), "inspected")
    new = seen.select(F.col("filename").alias("__f"), *[F.col(c).alias(f"__{c}") for c in ("width", "height", "mode")], F.col("filter_reason").isNull().alias("__valid"))
    both = rows.join(new, (F.col("filename") == F.col("__f")) & F.col("__need"), "left")
    filled = both.withColumns({c: F.when(F.col("__f").isNotNull() & stages.is_missing(F.col(c), k), F.col(f"__{c}")).otherwise(F.col(c)) for c, k in kinds.items()})
    out = filled.select(*[c for c in rows.columns if c != "__need"])
    counts = seen.agg(F.count("*").alias("needed"), F.count_if(F.col("filter_reason").isNotNull()).alias("invalid"), F.count_if(~F.col("image_exists")).alias("missing")).first().asDict()
    if not dry_run:
        newly = seen.join(rows.where("valid is null").select("filename"), "filename", "left_semi")
        audit = _kept(newly.select("filename", "filter_reason"), "backfill-audit")
        store.replace_table(out, target or source)
        store.audit(audit, cfg.filtered_download_path)
    return counts
