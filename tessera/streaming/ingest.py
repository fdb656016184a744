"""Incremental ingestion of annotation files: the checkpoint stands for the list of done files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "idx long, caption string, url string"


def ingest(spark: SparkSession, folder: str, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files: int = 100) -> StreamingQuery:
    """Run a stage over each batch of new JSON-lines files and append its rows."""
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).json(folder)
    return stage(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
