"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The characters that separate words, as text for btrim and as a Java pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

_written: list[tuple[object, object]] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local one only where none is set and all tasks run in this process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _delete(fs: object, path: object) -> None:
    try:
        fs.delete(path, True)
    except Exception:  # the JVM may be gone already
        pass


@atexit.register
def _clean() -> None:
    for fs, path in _written:
        _delete(fs, path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; it is removed when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _written.append((at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a materialized table that no later plan reads."""
    names = {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}
    for fs, path in _written:
        if any(n.endswith(path.getName()) for n in names):
            _delete(fs, path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(text: Column) -> Column:
    """The text without outer blanks; null counts as empty."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))


def words(text: Column) -> Column:
    """The array of maximal runs of non-blank characters; empty for null."""
    return let(trimmed(text), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN)))


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once for a row, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most so many rows, so that what a worker makes of one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Rows whose running sum one task works out at a time.
RUN = 4096


def prefix_sums(rows: DataFrame, value: str, out: str, order: str, *by: str) -> DataFrame:
    """rows with `out`: the sum of value over the rows of the same `by` that come earlier in the order, a whole number >= 0.

    Sums run within runs of RUN places, over the runs of a run of RUN runs, and
    over those, so that no task needs all rows of one `by`.
    """
    keys, earlier = list(by), lambda *p: Window.partitionBy(*p).rowsBetween(Window.unboundedPreceding, -1)
    run, far = "__run", "__far"
    marked = rows.withColumn(run, F.floor(F.col(order) / RUN)).withColumn(far, F.floor(F.col(order) / (RUN * RUN)))
    runs = marked.groupBy(*keys, run, far).agg(F.sum(value).alias("__sum"))
    fars = runs.groupBy(*keys, far).agg(F.sum("__sum").alias("__all"))
    fars = fars.withColumn("__first", F.coalesce(F.sum("__all").over(earlier(*keys).orderBy(far)), F.lit(0)))
    runs = runs.withColumn("__second", F.coalesce(F.sum("__sum").over(earlier(*keys, far).orderBy(run)), F.lit(0)))
    third = F.coalesce(F.sum(value).over(earlier(*keys, far, run).orderBy(order)), F.lit(0))

    def joined(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
        right = right.withColumnsRenamed({c: f"{c}__r" for c in on})
        return left.join(right, reduce(and_, [left[c].eqNullSafe(right[f"{c}__r"]) for c in on])).drop(*[f"{c}__r" for c in on])

    offsets = joined(runs, fars.drop("__all"), *keys, far).select(*keys, run, (F.col("__first") + F.col("__second")).alias("__before"))
    found = joined(marked.withColumn("__third", third), offsets, *keys, run)
    return found.withColumn(out, F.col("__before") + F.col("__third")).drop(run, far, "__third", "__before")


def hash_sample(rows: DataFrame, most: int, *cols: str) -> DataFrame:
    """At most `most` rows, chosen by the hash of distinct columns; about as many leave the tasks, at any size.

    The count sets a bound of the hash that about a fifth more rows pass, so
    tasks do not each send their own first rows to be compared.
    """
    n = rows.count()
    h = F.xxhash64(*cols)
    share = F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))
    picked = rows.where(share < 1.2 * most / n) if n > most else rows
    return picked.orderBy(h, *cols).limit(most)
