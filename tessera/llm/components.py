"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _least(edges: DataFrame) -> DataFrame:
    """For each u its least neighbour or itself."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _least(down)
    linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root is the least node of its component.

    Each round ends in a written table, so the plan stays short and lost
    executors cost one round.  A round only takes minima for each node, so a
    hub is pre-aggregated before it is shuffled.
    """
    edges = materialize(links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = state
        after = materialize(_small_star(_large_star(edges)), "edges")
        discard(edges)
        edges = after


#: Rows of hashes and ids up to this number are sent to the tasks, so that no text moves; more are joined by a shuffle.
SENT = 1_000_000


def sent_if_few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= SENT else rows


def one_row_each(docs: DataFrame, marked: DataFrame, roots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of docs for each component of marked (id, text_hash, fp): the smallest id, null last, then the least text hash.

    Equal texts are in one component, so id and text hash name a row up to its
    exact copies; the id alone does not, as it may be null or repeated.  Where
    few rows go, they are sent to the tasks; else rows meet by a shuffle.
    """
    found = marked.groupBy("id", "text_hash", "fp").agg(F.count("*").alias("n"))
    named = found.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(named, "named")
    least = named.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("least"))
    stays = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("text_hash") == F.col("least.text_hash"))
    judged = named.join(least, "root").select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "n", stays.alias("__stays"))
    odd = materialize(judged.where("not __stays or n > 1"), "odd")  # what goes, and what stays but is repeated
    rows = docs.withColumn("__text", F.xxhash64(text_col))
    same = lambda right: rows[id_col].eqNullSafe(right["__id"]) & (rows["__text"] == right["__hash"])
    if odd.count() <= SENT:
        out = rows.join(F.broadcast(odd), same(odd), "left_anti")
        again = odd.where("__stays")
        if not again.isEmpty():
            out = out.unionByName(rows.join(F.broadcast(again), same(again), "left_semi").dropDuplicates([id_col, "__text"]))
    else:
        kept = judged.where("__stays")
        out = rows.join(kept, same(kept), "left_semi").dropDuplicates([id_col, "__text"])
    return out.drop("__text")
