"""Stage tables on shared storage: staging, discovery, atomic replacement, clean-up, merge and JSON export."""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stages import keep_last

#: Stages in the order in which they are merged, and the column by which a row replaces another.
STAGE_KEYS = {"metadata": "source_url", "scene_graphs": "filename", "semantic_annotations": "filename", "annotated": "filename"}
_NAME = re.compile(r"(.+)_shard(\d+)_n(\d+)_b(\d+)\.parquet")


class Storage:
    """The file system that Spark sees under a path."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(folder))) if self.exists(folder) else []

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def make(self, folder: str) -> None:
        self.fs.mkdirs(self._path(folder))

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that the cluster names in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Staged:
    """A staged table's place: `folder`/_staging/`stage`_shard`shard`_n`shards`_b`run`.parquet."""

    folder: str
    stage: str
    shard: int
    shards: int
    run: int

    @property
    def name(self) -> str:
        return f"{self.stage}_shard{self.shard}_n{self.shards}_b{self.run}.parquet"

    @property
    def path(self) -> str:
        return f"{self.folder}/_staging/{self.name}"


def canonical(folder: str, stage: str) -> str:
    return f"{folder}/{stage}.parquet"


def new_staged(folder: str, stage: str, shard: int, shards: int) -> Staged:
    return Staged(folder, stage, shard, shards, int(time.time()))


def staged_tables(spark: SparkSession, folder: str, stage: str, shard: int | None = None, shards: int | None = None) -> list[Staged]:
    """The staged tables of a stage, by name; of one shard if it is given."""
    found = []
    for name in Storage(spark, folder).names(f"{folder}/_staging"):
        m = _NAME.fullmatch(name)
        if m and m[1] == stage and (shard is None or (int(m[2]), int(m[3])) == (shard, shards)):
            found.append(Staged(folder, stage, int(m[2]), int(m[3]), int(m[4])))
    return found


def append(rows: DataFrame, path: str) -> None:
    """New part files beside the old ones: nothing is rewritten, and a failed job adds nothing."""
    rows.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with the union of its files' columns; None where there is none."""
    return spark.read.option("mergeSchema", "true").parquet(path) if Storage(spark, path).exists(path) else None


def replace_table(rows: DataFrame, path: str) -> None:
    """Write beside the table, then swap by renaming: readers see the old table or the new one, and the plan may read the old."""
    storage = Storage(rows.sparkSession, path)
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(fresh)
        if storage.exists(path):
            storage.rename(path, old)
            try:
                storage.rename(fresh, path)
            except Exception:
                storage.rename(old, path)
                raise
            storage.delete(old)
        else:
            storage.rename(fresh, path)
    finally:
        storage.delete(fresh)


def merged_rows(spark: SparkSession, folder: str, stage: str, found: list[Staged], legacy_order: bool = False) -> DataFrame:
    """The canonical table and the staged ones with one row for each key: staged beat canonical, later runs earlier ones.

    Of one run the higher shard wins.  legacy_order ranks staged tables by name,
    so shard 10 before shard 2, as a plain listing does.  Columns are united.
    """
    order = sorted(found, key=(lambda s: s.name) if legacy_order else (lambda s: (s.run, s.shard, s.shards)))
    old = read_table(spark, canonical(folder, stage))
    tables = [*([old] if old is not None else []), *(read_table(spark, s.path) for s in order)]
    numbered = [t.withColumn("__table", F.lit(i)) for i, t in enumerate(tables)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    key = STAGE_KEYS.get(stage, "filename")
    return (keep_last(both, key, F.col("__table")) if key in both.columns else both).drop("__table")


def merge_stage(spark: SparkSession, folder: str, stage: str, legacy_order: bool = False) -> dict[str, int] | None:
    """Merge what is staged into the canonical table and remove it; None where nothing is staged.

    Returns the rows before and after and the number of staged tables.  The
    staged tables go after the swap: a failure before leaves everything as it was,
    and merging again changes nothing.
    """
    found = staged_tables(spark, folder, stage)
    if not found:
        return None
    path = canonical(folder, stage)
    old = read_table(spark, path)
    before = old.count() if old is not None else 0
    replace_table(merged_rows(spark, folder, stage, found, legacy_order), path)
    for s in found:
        Storage(spark, folder).delete(s.path)
    return {"before": before, "after": read_table(spark, path).count(), "staged": len(found)}


def merge_all(spark: SparkSession, folder: str, legacy_order: bool = False) -> dict[str, dict[str, int] | None]:
    """Every stage in pipeline order; the first failure stops."""
    return {stage: merge_stage(spark, folder, stage, legacy_order) for stage in STAGE_KEYS}


def audit(rows: DataFrame, path: str, reason: str = "filter_reason") -> None:
    """Append (filename, filter_reason) of rows with a reason that the audit table does not list yet."""
    new = rows.where(F.col(reason).isNotNull()).select("filename", F.col(reason).alias("filter_reason")).dropDuplicates(["filename"])
    known = read_table(rows.sparkSession, path)
    append(new if known is None else new.join(known.select("filename"), "filename", "left_anti"), path)


def export_lines(rows: DataFrame, path: str) -> None:
    """One JSON object for each row, nulls written out, many files: the form for large tables."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_array(rows: DataFrame, path: str) -> int:
    """One indented JSON array in one file, streamed a partition at a time; returns the number of records."""
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        for line in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator(prefetchPartitions=True):
            body = json.dumps(json.loads(line.j), indent=2, ensure_ascii=False).replace("\n", "\n  ")
            out.write(("[\n  " if n == 0 else ",\n  ") + body)
            n += 1
        out.write("\n]" if n else "[]")
    return n
