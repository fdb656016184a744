"""Detections made from the star schema: an image for each order, a box for each of its lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as g

WIDTH, HEIGHT = 280.0, 180.0
KIND = "array<struct<label:string,bbox:array<double>,confidence:double,depth_value:double,position:string,depth_rank:int,area_rank:int,free_space:string,idx:int>>"


#: Bytes of a table's files for each partition that its rows are dealt to: some 200,000 lines.
DEALT_BYTES = 4 << 20


def file_bytes(table: DataFrame) -> int:
    """The size of a table as the planner takes it from its files."""
    return int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def deals(table: DataFrame) -> int:
    """Partitions of DEALT_BYTES each, so that a task's memory does not grow with the table; 0 where the session's own number is enough."""
    n = -(-file_bytes(table) // DEALT_BYTES)
    return n if n > int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")) else 0


def dealt(rows: DataFrame, n: int, *keys: Column) -> DataFrame:
    return rows.repartition(n, *keys) if n else rows


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, idx, label, bbox, confidence, depth_value, mask_area); of large tables the rows are dealt by image."""
    lines, parts = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part"))
    n, parts = deals(lines), parts.select("p_partkey", "p_name")
    if n and file_bytes(parts) > spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        # the parts of a partition as a hash table: the lines, many times as many, are not sorted for the join
        lines, parts = dealt(lines, n, F.col("l_partkey")), parts.hint("shuffle_hash")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    x, y = (F.col("l_partkey") % 8 * 20).cast("double"), (F.col("l_suppkey") % 6 * 20).cast("double")
    depth = F.when(~((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7)), F.col("l_discount") * 10)
    rows = dealt(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")), n, F.col("l_orderkey"))
    bbox = F.array(x, y, x + 40 + 2 * F.col("l_quantity"), y + 30 + F.col("l_quantity"))
    return rows.select(
        F.col("l_orderkey").alias("image"), F.row_number().over(order).alias("idx"), F.col("p_name").alias("label"), bbox.alias("bbox"),
        (F.col("l_quantity") / 51).alias("confidence"), depth.alias("depth_value"), F.col("l_quantity").alias("mask_area"),
    )


def ranked(rows: DataFrame) -> DataFrame:
    """Depth and area ranks, 1 first, stable; 0 where there is no depth."""
    image = Window.partitionBy("image")
    deep = F.row_number().over(image.orderBy(F.col("depth_value").asc_nulls_last(), "idx"))
    return rows.withColumn("depth_rank", F.when(F.col("depth_value").isNotNull(), deep).otherwise(0)).withColumn("area_rank", F.row_number().over(image.orderBy(F.col("mask_area").desc(), "idx")))


def placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("position", g.position(g.horizontal(F.col("bbox"), F.lit(WIDTH)), g.vertical(F.col("depth_value"))))


def lists(rows: DataFrame, *cols: str) -> DataFrame:
    """(image, dets): the detections of each image in order, with those of their columns that a query needs."""
    return rows.groupBy("image").agg(F.sort_array(F.collect_list(F.struct("idx", *cols))).alias("dets"))


def images(rows: DataFrame) -> DataFrame:
    """(image, dets): the detections of each image in order, with ranks, positions and free space."""
    found = lists(rows, "label", "bbox", "confidence", "depth_value", "mask_area")
    return found.select("image", g.with_geometry(F.col("dets"), F.lit(WIDTH), F.lit(HEIGHT), "idx").alias("dets"))


def suppressed_images(rows: DataFrame) -> DataFrame:
    return images(rows).select("image", g.survivors(F.col("dets"), KIND).alias("dets"))


def suppressed_lists(rows: DataFrame) -> DataFrame:
    """(image, dets) after suppression with idx, label and box only: no ranks and no free space are worked out."""
    kind = "array<struct<idx:int,label:string,bbox:array<double>>>"
    return lists(rows, "label", "bbox").select("image", g.survivors(F.col("dets"), kind).alias("dets"))
