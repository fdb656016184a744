"""SimHash near-duplicates: pigeonhole blocks, verified Hamming distance, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components, one_row_each

#: XXH64 seed of the shingle hash.
SEED = 42
#: Groups up to this size are compared as pairs in the JVM.
PAIRWISE = 64
#: Groups up to this size are linked in one Python call; larger ones are keyed anew by more blocks.
GROUP_MAX = 1 << 16
#: With 16 blocks and 4 differing bits, a key holds 48 of 64 bits: at most 2**16 distinct fingerprints share it.
FINE_BLOCKS = 16


def votes_of(h: np.ndarray) -> np.ndarray:
    """How many of the hashes set each of the 64 bits."""
    return np.unpackbits(h.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(votes: np.ndarray, n: int) -> int:
    """The bits that over half of n hashes set."""
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 for a text without words."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    n = len(found) - width + 1
    votes = np.zeros(64, dtype=np.int64)
    if n < 1:
        n, starts, ends = 1, [0], [len(joined)]
    else:
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        stop = np.cumsum(size + 1) - 1
        ends = stop[width - 1 :].tolist()
        starts = (stop - size)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)], strict=True)], dtype="<u8")
        votes += votes_of(h)
    return majority(votes, n)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, text_hash, fp): fp is the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, width) for t in b.column(2).cast(pa.binary()).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["id", "text_hash", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, text_hash long, fp long")


def masks(blocks: int, max_bits: int) -> list[int]:
    """Masks of all sets of blocks that stay equal when max_bits bits differ."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(kept) for kept in combinations(part, blocks - max_bits)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def blocks_for(n: int, max_bits: int) -> int:
    """Blocks whose key is wider than log2(n): random fingerprints then rarely meet, at any size."""
    for m in range(max_bits + 2, FINE_BLOCKS):
        if 64 * (m - max_bits) / m >= max(1, n).bit_length() + 1:
            return m
    return FINE_BLOCKS


def keyed(fps: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """(combo, key, fp): one row for each set of blocks."""
    kept = F.split(F.lit(",".join(str(signed(m)) for m in masks(blocks, max_bits))), ",").cast("array<bigint>")
    rows = fps.select(F.posexplode(kept).alias("combo", "mask"), "fp")
    return rows.select("combo", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within max_bits, without listing all pairs."""
    left = np.unique(fps.astype(np.int64)).view(np.uint64)
    links: list[tuple[int, int]] = []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            links += [(int(np.int64(x.view(np.int64))), int(y)) for y in left[near].view(np.int64)]
            todo += list(left[near])
            left = left[~near]
    return links


def _forests(grouped, max_bits: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(forest(pdf["fp"].to_numpy(), max_bits), columns=["a", "b"], dtype="int64")

    return grouped.applyInPandas(run, "a long, b long")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose key at least two fingerprints share, with the group's size n."""
    met = rows.groupBy("combo", "key").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(met, ["combo", "key"])


def _group_links(many: DataFrame, max_bits: int, pairwise: int) -> DataFrame:
    """Pairs of small groups by JVM expressions, spanning forests of larger ones."""
    lists = many.where(F.col("n") <= pairwise).groupBy("combo", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = lists.select(F.posexplode("fps").alias("i", "a"), "fps").select("a", F.explode(F.slice("fps", F.col("i") + 2, F.size("fps"))).alias("b"))
    small = pairs.where(distance(F.col("a"), F.col("b")) <= max_bits)
    return small.unionByName(_forests(many.where(F.col("n") > pairwise).select("combo", "key", "fp").groupBy("combo", "key"), max_bits))


def fingerprint_links(fps: DataFrame, max_bits: int = 4, pairwise: int = PAIRWISE, group_max: int = GROUP_MAX, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all within max_bits.

    Fingerprints that differ in at most max_bits of `blocks` blocks agree on the
    others, so every such pair meets under one key.  Small groups are compared
    as pairs; larger ones give a spanning forest; groups beyond group_max are
    keyed again by finer blocks, where 48 fixed bits bound every group.
    """
    many = _shared(keyed(fps, blocks or blocks_for(fps.count(), max_bits), max_bits))
    huge = _shared(keyed(many.where(F.col("n") > group_max).select("fp").distinct(), FINE_BLOCKS, max_bits))
    links = _group_links(many.where(F.col("n") <= group_max), max_bits, pairwise).unionByName(_group_links(huge, max_bits, PAIRWISE))
    return links.distinct()


def linked(docs: DataFrame, id_col: str, text_col: str, width: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, fp) of every row, and (node, root) of the fingerprints that have links."""
    marked = materialize(with_fingerprints(docs, id_col, text_col, width), "fingerprints")
    links = materialize(fingerprint_links(marked.select("fp").distinct(), max_bits), "links")
    return marked, connected_components(links)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4) -> DataFrame:
    """(id, fp, component_id) of every row; component_id is the smallest id reachable by links.

    Null and blank texts have fingerprint 0 and link like any other; texts of
    fewer than `width` words are one shingle; very long texts are read whole;
    repeated rows give repeated rows; null ids get their component's smallest id
    (null if it has none); an empty table gives no rows; other columns are not
    read.
    """
    marked, roots = linked(docs, id_col, text_col, width, max_bits)
    nodes = marked.groupBy("fp").agg(F.min("id").alias("least"))
    named = nodes.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(named, "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of docs for each component: the smallest id, null last, then the least text hash.

    Rows without an id stay only where no row of their component has one, one
    for each component; an id that repeats with other texts is judged by them.
    """
    marked, roots = linked(docs, id_col, text_col, width, max_bits)
    return one_row_each(docs, marked, roots, id_col, text_col)
