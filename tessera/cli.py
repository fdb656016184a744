"""Command line: python -m tessera.cli STAGE ..."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession

from .config import load
from .operators import scenes, stages, store
from .plans import runs
from .sources.annotations import annotation_array, annotation_lines


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *groups: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.add_argument("--config", default="config.toml")
        if "shard" in groups:
            p.add_argument("--shard-id", type=int, default=0)
            p.add_argument("--num-shards", type=int, default=1)
            p.add_argument("--limit", type=int)
        if "calls" in groups:
            p.add_argument("--concurrency", type=int)
        if "verify" in groups:
            p.add_argument("--verify", action="store_true")
            p.add_argument("--no-verify", action="store_true")
        return p

    p = command("download", "shard")
    p.add_argument("--annotations")
    p.add_argument("--skip-staging", action="store_true")
    p = command("extract_scene_graphs", "shard", "calls")
    p.add_argument("--model", required=True, help="module:function that makes a scene model")
    command("extract_semantic", "shard", "calls", "verify")
    p = command("annotate", "shard", "calls", "verify")
    p.add_argument("--pipeline", default="robotic", choices=sorted(runs.annotators.PIPELINES))
    p.add_argument("--overwrite", action="store_true")
    p = command("merge")
    which = p.add_mutually_exclusive_group(required=True)
    which.add_argument("--stage", choices=list(store.STAGE_KEYS))
    which.add_argument("--all", action="store_true")
    p.add_argument("--data-dir", default="data")
    p.add_argument("--legacy-order", action="store_true")
    p = command("backfill_metadata")
    p.add_argument("--input")
    p.add_argument("--output")
    p.add_argument("--limit", type=int)
    p.add_argument("--dry-run", action="store_true")
    p = command("export_json")
    p.add_argument("--input", default="data/annotated.parquet")
    p.add_argument("--output")
    p.add_argument("--caption-col")
    p.add_argument("--lines", action="store_true", help="many files of JSON lines")
    p = command("show_parquet")
    p.add_argument("path", nargs="?", default="data/annotated.parquet")
    p.add_argument("--cols", nargs="+")
    p.add_argument("--head", type=int)
    p.add_argument("--info", action="store_true")
    p.add_argument("--report", metavar="FILE", help="the texts of each row as a Markdown report")
    p = command("count_scene_graph_rows")
    p.add_argument("path", nargs="?")
    p = command("rebuild_scene_graphs")
    p.add_argument("path", nargs="?", default="data/scene_graphs.parquet")
    return top


def verify_of(args: argparse.Namespace) -> bool | None:
    """Extraction lets --verify win over --no-verify, captioning the other way round; semantic captions are only verified on demand."""
    if args.command == "extract_semantic":
        return True if args.verify else False if args.no_verify else None
    if args.no_verify:
        return False
    return True if args.verify else False if args.pipeline == "semantic" else None


def report(rows: DataFrame, path: str) -> int:
    """Each row's texts, a section each, streamed to a file; returns the number of sections."""
    n, at = 0, None
    with open(path, "w", encoding="utf-8") as out:
        for r in stages.sections(rows).orderBy("filename", "place").toLocalIterator(prefetchPartitions=True):
            if r.filename != at:
                at = r.filename
                out.write(f"# {at}\n\n")
            out.write(f"## {r.section}\n\n{r.text}\n\n")
            n += 1
    return n


def run(spark: SparkSession, argv: list[str]) -> object:
    """Run one command; returns what it prints."""
    args = parser().parse_args(argv)
    cfg = load(args.config)
    name = args.command
    if name in {"download", "extract_scene_graphs", "extract_semantic", "annotate"}:
        limit = {"download_limit" if name == "download" else "annotate_limit": args.limit}
        cfg = cfg.but(**limit, concurrency=getattr(args, "concurrency", None), overwrite=getattr(args, "overwrite", False) or None)
        if hasattr(args, "verify"):
            cfg = cfg.but(verify=verify_of(args))
    if name == "download":
        path = args.annotations or cfg.annotations_path
        rows = (annotation_lines if path.endswith(".jsonl") else annotation_array)(spark, path)
        return runs.download(cfg, rows, args.shard_id, args.num_shards, skip_staged=args.skip_staging).first().asDict()
    if name == "extract_scene_graphs":
        module, _, function = args.model.partition(":")
        return [r.asDict() for r in runs.extract_scene_graphs(cfg, spark, getattr(importlib.import_module(module), function), args.shard_id, args.num_shards).collect()]
    if name == "extract_semantic":
        return [r.asDict() for r in runs.extract_semantic(cfg, spark, None, args.shard_id, args.num_shards).collect()]
    if name == "annotate":
        return [r.asDict() for r in runs.annotate(cfg, spark, args.pipeline, None, args.shard_id, args.num_shards).collect()]
    if name == "merge":
        return store.merge_all(spark, args.data_dir, args.legacy_order) if args.all else {args.stage: store.merge_stage(spark, args.data_dir, args.stage, args.legacy_order)}
    if name == "backfill_metadata":
        return runs.backfill(cfg, spark, args.input, args.output, args.limit, args.dry_run)
    if name == "rebuild_scene_graphs":
        rows = scenes.rebuilt(spark.read.parquet(args.path))
        store.replace_table(rows, args.path)
        return store.read_table(spark, args.path).count()
    if name == "count_scene_graph_rows":
        return stages.valid_counts(spark.read.parquet(args.path or cfg.scene_graph_path)).first().asDict()
    if name == "export_json":
        rows = stages.exported(spark.read.parquet(args.input), args.caption_col)
        target = args.output or args.input.removesuffix(".parquet") + ".json"
        return store.export_lines(rows, target) if args.lines else store.export_array(rows, target)
    rows = spark.read.parquet(args.path)
    rows = rows.limit(args.head) if args.head else rows
    if args.report:
        return report(rows, args.report)
    if args.info:
        return {"rows": rows.count(), "schema": rows.schema.simpleString()}
    shown = stages.selected(rows, args.cols) if args.cols else rows
    return "\n".join(str(r.asDict()) for r in shown.toLocalIterator())


def main() -> None:
    import sys

    print(run(SparkSession.builder.appName("tessera").getOrCreate(), sys.argv[1:]))


if __name__ == "__main__":
    main()
