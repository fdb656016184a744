"""Annotation input: JSON lines with an explicit index, or one JSON array."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "idx long, caption string, url string"


def annotation_lines(spark: SparkSession, path: str) -> DataFrame:
    """(idx, caption, url) of JSON lines that name their place: split over tasks at any size, the form for large inputs."""
    return spark.read.schema(SCHEMA).json(path)


def annotation_array(spark: SparkSession, path: str) -> DataFrame:
    """(idx, caption, url) of one JSON array file; idx is the place in the array.

    The file is one row of one task, as an array has no places to split it at;
    to_lines turns it into a form that large inputs need.
    """
    whole = spark.read.text(path, wholetext=True)
    items = F.from_json("value", "array<struct<caption: string, url: string>>")
    return whole.select(F.posexplode(items).alias("idx", "a")).select(F.col("idx").cast("long").alias("idx"), "a.caption", "a.url")


def to_lines(rows: DataFrame, path: str, files: int = 16) -> None:
    """Write annotations as JSON lines with their index."""
    rows.repartition(files, "idx").write.mode("overwrite").json(path)


def shard_of(rows: DataFrame, shard: int, shards: int, limit: int | None = None) -> DataFrame:
    """Every shards-th annotation; the limit counts within the shard."""
    mine = rows.where(F.pmod(F.col("idx"), F.lit(shards)) == shard)
    return mine if limit is None else mine.orderBy("idx").limit(limit)
