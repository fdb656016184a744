"""Stage operators: resume, shard, merge, replace, audit, backfill and export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Caption columns by priority; missing kinds of a backfill.
CAPTIONS = ("new_caption", "semantic_caption", "spatial_caption", "type_a", "scene_type_a")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the done ones; a null key is done if a null is."""
    return rows.join(done.select(F.col(key).alias("__done")), F.col(key).eqNullSafe(F.col("__done")), "left_anti")


def first_rows(rows: DataFrame, order: str, n: int | None) -> DataFrame:
    """The first n by an explicit order; all without n."""
    return rows if n is None else rows.orderBy(order).limit(n)


def keep_last(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """For each key, null included, the row that comes last."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[c.desc() for c in order]))
    return rows.withColumn("__place", place).where("__place = 1").drop("__place")


def merged(canonical: DataFrame | None, staged: list[DataFrame], key: str) -> DataFrame:
    """One row for each key: later staged tables beat earlier ones, and all beat the canonical table.

    Columns are united; within a table the last row by its ordinal column, if it has one, stays.
    """
    tables = [t.withColumn("__table", F.lit(i)) for i, t in enumerate([*([canonical] if canonical is not None else []), *staged])]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    order = [F.col("__table"), *([F.col("ordinal")] if "ordinal" in both.columns else [])]
    return keep_last(both, key, *order).drop("__table")


def replaced(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Existing rows whose key is new go whole; the new rows come in."""
    return not_done(existing, new, key).unionByName(new, allowMissingColumns=True)


def valid_rows(rows: DataFrame) -> DataFrame:
    """Tables without the flag are all valid."""
    return rows.where("valid") if "valid" in rows.columns else rows


def valid_counts(rows: DataFrame) -> DataFrame:
    flag = F.col("valid") if "valid" in rows.columns else F.lit(True)
    return rows.agg(F.count("*").alias("total"), F.count_if(F.coalesce(flag, F.lit(False))).alias("valid"), F.count_if(flag.isNull()).alias("unknown"))


def reason_counts(rows: DataFrame, reason: str = "filter_reason") -> DataFrame:
    """How many rows went for each reason, by reason; rows without one are not counted."""
    return rows.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n")).orderBy(reason)


def error_counts(rows: DataFrame, error: str = "error") -> DataFrame:
    """How many rows failed for each class of error: what stands before its first colon."""
    kind = F.substring_index(error, ":", 1).alias("error_class")
    return rows.where(F.col(error).isNotNull()).groupBy(kind).agg(F.count("*").alias("n")).orderBy("error_class")


def done_keys(key: str, *tables: DataFrame | None) -> DataFrame | None:
    """The keys of the canonical table and of staged ones together; None without any table."""
    found = [t.select(key) for t in tables if t is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def joined(left: DataFrame, right: DataFrame, key: str, *cols: str) -> tuple[DataFrame, DataFrame]:
    """left joined to the columns of right, and a row with how many rows of left found no partner."""
    dropped = not_done(left, right, key).agg(F.count("*").alias("dropped"))
    return left.join(right.select(key, *cols), key), dropped


def needs_backfill(columns: list[str], **kinds: str) -> Column:
    """Whether any of the columns (name to type) is absent, null, or holds what counts as missing for its type."""
    out = F.lit(False)
    for name, kind in kinds.items():
        out = out | (is_missing(F.col(name), kind) if name in columns else F.lit(True))
    return out


def is_missing(value: Column, kind: str) -> Column:
    """Null; also zero for numbers and empty for text."""
    extra = {"string": value == "", "int": value == 0, "bigint": value == 0}.get(kind)
    return value.isNull() if extra is None else value.isNull() | extra


def kept_on_error(new: Column, old: Column, failed: Column) -> Column:
    """A recomputed value, or the old one where that failed."""
    return F.coalesce(F.when(~F.coalesce(failed, F.lit(False)), new), old)  # new is read once, so it is worked out once


def download_reason(error: Column, width: Column, height: Column, least: int = 4096) -> Column:
    """Why a fetched image is invalid, in the words of the download stage (fixed values); null if it is valid."""
    area = width * height
    text = F.format_string(f"too_small: %d\u00d7%d=%d px (min {least})", width, height, area)
    return F.when(error.isNotNull(), F.concat(F.lit("load_error: "), F.substring(error, 1, 120))).when(area < least, text)


def download_stats(rows: DataFrame, done: int) -> DataFrame:
    """total (pending in this shard), success, invalid, failed, and skipped, which is the size of the whole done set.

    rows: every pending annotation with `error` (null where the fetch worked) and `valid`.
    """
    fetched = F.col("error").isNull()
    return rows.agg(
        F.count("*").alias("total"), F.count_if(fetched & F.col("valid")).alias("success"), F.count_if(fetched & ~F.col("valid")).alias("invalid"),
        F.count_if(~fetched).alias("failed"), F.lit(done).cast("long").alias("skipped"),
    )


def validity_reason(exists: Column, size: Column, width: Column, height: Column, error: Column, least: int = 4096) -> Column:
    """The first check that an image fails; null if it passes all.  The reasons are fixed values."""
    return (
        F.when(~exists, "missing_file").when(size < 512, "file_too_small").when(error.isNotNull(), "load_error")
        .when((width == 0) | (height == 0), "zero_dimension").when(width * height < least, "too_small")
    )


def complexity_reason(n: Column, least: int = 2) -> Column:
    return F.when(n == 0, "no_objects").when(n < least, F.concat(F.lit("too_few_objects: "), n.cast("string"), F.lit(f" detected (threshold {least})")))


def backfilled(rows: DataFrame, **values: Column) -> DataFrame:
    """Only what is missing is filled: nulls, zero sizes, empty modes; absent columns are made."""
    out = rows
    for name, value in values.items():
        if name not in rows.columns:
            out = out.withColumn(name, value)
            continue
        c, kind = F.col(name), rows.schema[name].dataType.simpleString()
        out = out.withColumn(name, F.when(is_missing(c, kind), value).otherwise(c))
    return out


def selected(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns asked for; unknown ones are an error that names them."""
    unknown = [c for c in columns if c not in rows.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}; there are {rows.columns}")
    return rows.select(*columns)


def caption_column(columns: list[str]) -> str:
    """The first caption column that exists."""
    found = [c for c in CAPTIONS if c in columns]
    if not found:
        raise ValueError(f"no caption column among {columns}; name one")
    return found[0]


def exported(rows: DataFrame, caption: str | None = None) -> DataFrame:
    """filename, original_caption (null if the table has none), caption."""
    chosen = selected(rows, [caption]).columns[0] if caption else caption_column(rows.columns)
    old = F.col("caption") if "caption" in rows.columns else F.lit(None).cast("string")
    return rows.select("filename", old.alias("original_caption"), F.col(chosen).alias("caption"))


#: The sections of a report, in order.
SECTIONS = (
    "caption", "new_caption", "type_a", "type_b", "type_c", "spatial_caption", "scene_graph",
    "scene_type_a", "scene_type_b", "scene_type_c", "semantic_props", "semantic_rels", "semantic_caption",
)


def sections(rows: DataFrame, key: str = "filename") -> DataFrame:
    """(key, place, section, text): the texts a report shows for each row, those that are there and not null."""
    there = [c for c in SECTIONS if c in rows.columns]
    items = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("section"), F.col(c).cast("string").alias("text")) for i, c in enumerate(there)])
    return rows.select(key, F.inline(F.filter(items, lambda x: x["text"].isNotNull())))
