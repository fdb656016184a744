"""Near copies: SimHash links and an exact join of five-word-shingle sets with Jaccard similarity 0.8 or more, and their components.

Fingerprints of all texts meet in pigeonhole blocks; what they link is held
against the sets and united.  At 0.8 more bits differ than blocks allow for, so
an exact join of the sets follows for all that fingerprints leave apart.  Two sets that similar share a shingle among the first fifth of each, in any one
order of all shingles, and more among more; with the rare ones first, few others
meet there, and fewer often enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import discard, materialize, pieces
from .components import connected_components, one_row_each, sent_if_few
from .simhash import SEED, majority, signed, votes_of

#: Words of a shingle.
WIDTH = 5
#: A pair is similar if PART[0] / PART[1] of the shingles of either stand in both.
PART = (4, 5)
#: Differing bits up to which fingerprints link.
BITS = 4
#: Hashes whose bits are counted at a time.
VOTES = 1 << 16
#: Texts, chosen by hash, in which shingles are counted, about: the counts only order the shingles, so they set the work
#: and not the result.  Counters: one byte each, at any input size; sent on in PARTS rows.
SAMPLE_TEXTS, COUNTERS, PARTS = 20_000, 1 << 22, 16
#: Sets under a key up to this number are paired by a join; more are compared in blocks of BLOCK sets in numpy.
PAIRWISE, BLOCK = 64, 2048
#: Counts of a set's shingles by hash, one byte each, from which a least distance of two sets follows.
BUCKETS = 256


def shingles(text: bytes | None) -> np.ndarray:
    """The 64-bit hashes of the word shingles, repeats included; a shorter text is one shingle, a blank one has none."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined, n = b" ".join(found), len(found) - WIDTH + 1
    digest = xxhash.xxh64_intdigest
    if n < 1:
        h = [digest(joined, SEED)]
    else:
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        stop = np.cumsum(size + 1) - 1
        h = [digest(joined[a:b], SEED) for a, b in zip((stop - size)[:n].tolist(), stop[WIDTH - 1 :].tolist(), strict=True)]
    return np.array(h, dtype=np.uint64)


def distinct(h: np.ndarray) -> np.ndarray:
    return np.unique(h.view(np.int64))


def shingle_set(text: bytes | None) -> np.ndarray:
    """The distinct hashes of the word shingles, ascending."""
    return distinct(shingles(text))


def mark_of(h: np.ndarray) -> int:
    """The SimHash fingerprint of a text's shingles, as a signed long; 0 for none."""
    votes = sum((votes_of(h[at : at + VOTES]) for at in range(0, len(h), VOTES)), np.zeros(64, dtype=np.int64))
    return signed(majority(votes, len(h)))


def set_id(s: np.ndarray) -> int:
    """The hash of a set, which stands for it."""
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).view(np.int64))


def counters(s: np.ndarray) -> np.ndarray:
    return s & (COUNTERS - 1)


def more(n):
    """How many shingles of the prefixes similar sets of at least n shingles share; for numbers and columns."""
    return n // 10 + 1 if isinstance(n, int) else F.floor(n / 10) + 1


def prefix(s: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """The shingles, rare ones first, of which a similar set has at least more(the smaller size) among its own.

    At least four fifths of the shingles are shared, so of any fifth and one
    more, in one order of all shingles, one is; of k further ones, k more are.
    """
    least = -(-len(s) * PART[0] // PART[1])
    return s[np.lexsort((s, counted[counters(s)]))[: len(s) - least + more(len(s))]]


def similar(both: Column, a: Column, b: Column) -> Column:
    """Whether the Jaccard similarity reaches PART, in whole numbers."""
    return both * (PART[0] + PART[1]) >= (a + b) * PART[0]


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """In how many texts (one column) of the sample the shingles of each counter stand, up to 255."""
    name = texts.columns[0]
    h = F.xxhash64(F.lit(SEED), name)
    share = F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))
    some = texts.where(share < SAMPLE_TEXTS / max(1, texts.count())).withColumn("__h", h).dropDuplicates(["__h"]).select(name)
    width = COUNTERS // PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sets = [counters(shingle_set(t)) for t in b.column(0).cast(pa.binary()).to_pylist()]
            at, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            edges = np.searchsorted(at, np.arange(PARTS + 1) * width)
            packed = [np.stack([at[x:y] % width, n[x:y]]).astype("<i4").tobytes() for x, y in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int64()), pa.array(packed, pa.binary())], names=["part", "n"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(width, dtype=np.int64)
        for b in batches:
            for x in b.column("n").to_pylist():
                at, k = np.frombuffer(x, "<i4").reshape(2, -1)
                n[at] += k
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([np.minimum(n, 255).astype(np.uint8).tobytes()], pa.binary())], names=["part", "n"])

    rows = some.mapInArrow(count, "part long, n binary").groupBy("part").applyInArrow(add, "part long, n binary").collect()
    out = np.zeros((PARTS, width), dtype=np.uint8)
    for r in rows:
        out[r.part] = np.frombuffer(r.n, np.uint8)
    return out.ravel()


def with_prefixes(docs: DataFrame, counted: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, fp, mark, size, keys) of every row: fp stands for its set, mark is its SimHash fingerprint, keys are the set's prefix."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(counted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = shared.value
        for b in pieces(batches):
            rows = []
            for t in b.column(2).cast(pa.binary()).to_pylist():
                h = shingles(t)
                s = distinct(h)
                rows.append((set_id(s), mark_of(h), len(s), prefix(s, n) if len(s) else s))
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], names=["id", "text_hash", "fp", "mark", "size", "keys"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, text_hash long, fp long, mark long, size long, keys array<bigint>")


def alike(marks: DataFrame) -> DataFrame:
    """(a, b) of sets with linked fingerprints, from (mark, fp): enough pairs to connect all within BITS bits.

    Each set is paired with the first of its fingerprint, and these along the
    fingerprints' links, so a fingerprint of many sets makes no pairs of all.
    """
    heads = materialize(marks.groupBy("mark").agg(F.min("fp").alias("head")), "heads")
    links = simhash.fingerprint_links(heads.select(F.col("mark").alias("fp")), BITS)
    side = lambda x: heads.select(F.col("mark").alias(x), F.col("head").alias(f"head_{x}"))
    across = links.join(side("a"), "a").join(side("b"), "b").select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    pairs = marks.join(heads, "mark").select(F.col("fp").alias("a"), F.col("head").alias("b")).unionByName(across)
    found = materialize(pairs.where("a <> b").distinct(), "alike")
    discard(heads)
    return found


def still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) that roots (node, root) do not unite."""
    known = sent_if_few(roots)
    side = lambda x: known.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    named = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return named.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def histogram(s: np.ndarray) -> bytes:
    """The set's counts by bucket, up to 255."""
    return np.minimum(np.bincount((s >> 32) & (BUCKETS - 1), minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def sets_of(texts: DataFrame) -> DataFrame:
    """(fp, s, counts) of texts (one column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sets = [shingle_set(t) for t in b.column(0).cast(pa.binary()).to_pylist()]
            cols = [pa.array([set_id(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array([histogram(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["fp", "s", "counts"])

    return texts.mapInArrow(run, "fp long, s array<bigint>, counts binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    met = pairs.join(sets.select(F.col("fp").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("fp").alias("b"), F.col("s").alias("sb")), "b")
    return met.where(similar(F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb"))).select("a", "b")


def shared_keys(keyed: DataFrame) -> DataFrame:
    """The rows (key, fp, ...) whose key is met at least twice."""
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(many.select("key"), "key")


def close(a, b):
    """Whether the sizes allow for similarity; for columns and arrays."""
    return (a * PART[0] <= b * PART[1]) & (b * PART[0] <= a * PART[1])


def small_pairs(members: DataFrame) -> DataFrame:
    """(a, b) that are apart and meet under keys of few sets, often enough with all their other keys counted in."""
    many = members.groupBy("fp").agg(F.count_if(F.col("n") > PAIRWISE).alias("hot"))
    few = members.where(F.col("n") <= PAIRWISE).join(many, "fp")
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("size", "root", "hot")]
    left, right = few.select("key", F.col("fp").alias("a"), *side("a")), few.select("key", F.col("fp").alias("b"), *side("b"))
    met = left.join(right, "key").where((F.col("root_a") < F.col("root_b")) & close(F.col("size_a"), F.col("size_b")))
    both = met.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.least("hot_a", "hot_b")).alias("hot"), F.min(F.least("size_a", "size_b")).alias("least"))
    return both.where(F.col("n") + F.col("hot") >= more(F.col("least"))).select("a", "b")


def screened(left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs that are apart and may be similar: (sizes, roots, counts) of each side.

    Similar sets differ in at most a ninth of their shingles together, and the
    differences of their counts add up to no more than that.
    """
    found = [], []
    for i, (size, root, counts) in enumerate(zip(*left, strict=True)):
        may = np.flatnonzero(close(size, right[0]) & (right[1] > root))
        apart = np.abs(right[2][may].astype(np.int16) - counts.astype(np.int16)).sum(axis=1)
        may = may[apart * (PART[0] + PART[1]) <= (size + right[0][may]) * (PART[1] - PART[0])]
        found[0].append(np.full(len(may), i)), found[1].append(may)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def large_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) that may be similar among the sets under keys of many: compared in blocks, so that no task needs a whole key."""
    hot = members.where(F.col("n") > PAIRWISE).join(sets.select("fp", "counts"), "fp")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    hot = hot.withColumn("block", F.pmod(F.xxhash64("fp"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = hot.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "fp", "size", "root", "counts")

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches)
        block, fp, size, root = (t.column(c).to_numpy() for c in ("block", "fp", "size", "root"))
        counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint8).reshape(len(fp), -1)
        x, y = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        for one, two in ((left, right),) if x == y else ((left, right), (right, left)):
            i, j = screened((size[one], root[one], counts[one]), (size[two], root[two], counts[two]))
            yield pa.RecordBatch.from_arrays([pa.array(fp[one][i], pa.int64()), pa.array(fp[two][j], pa.int64())], names=["a", "b"])

    return dealt.groupBy("key", "x", "y").applyInArrow(run, "a long, b long")


def shared_keys(keyed: DataFrame) -> DataFrame:
    """The rows (key, fp, ...) whose key is met at least twice, with n, how often."""
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(many, "key")


def set_roots(prefixes: DataFrame, marked: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of the sets that are linked to others; prefixes are read first and freed, texts are (text_hash, t).

    First the fingerprints of all sets are linked.  A similar set shares enough
    keys with others; one of which a passage stands elsewhere shares too few
    and is like none.  Of the others, what fingerprints link and the sets
    confirm is united.  Then the sets under a key are compared with one of
    them, the one that shares most keys, unless united, and what is similar is
    united.  Then the sets under a key that are still apart are compared: few
    ones as pairs, many ones by a bound of their distance, so that only pairs
    that may be similar leave a task.  No similar pair is left apart.
    """
    linked = alike(prefixes.select("mark", "fp").distinct())
    keyed = prefixes.select("fp", "size", "keys").dropDuplicates(["fp"]).select(F.explode("keys").alias("key"), "fp", "size")
    met = materialize(shared_keys(keyed).drop("n"), "met")
    discard(prefixes)
    # a similar set has at least four fifths of the size
    enough = F.col("shared") >= more(F.ceil(F.col("size") * PART[0] / PART[1]))
    able = met.groupBy("fp", "size").agg(F.count("*").alias("shared")).where(enough)
    before, met = met, materialize(shared_keys(met.join(able.select("fp", "shared"), "fp")), "able")
    discard(before)
    one = marked.join(met.select("fp").distinct(), "fp", "left_semi").groupBy("fp").agg(F.min("text_hash").alias("text_hash"))
    one = sent_if_few(materialize(one.select("text_hash"), "set-texts"))
    sets = materialize(sets_of(texts.join(one, "text_hash", "left_semi").dropDuplicates(["text_hash"]).select("t")), "sets")
    links = materialize(verified(linked, sets), "links")
    discard(linked)
    heads = met.groupBy("key").agg(F.max_by(F.struct("fp", "size"), F.struct("shared", F.xxhash64("fp"))).alias("h"))
    pairs = met.join(heads, "key").where((F.col("fp") != F.col("h.fp")) & close(F.col("size"), F.col("h.size"))).select(F.col("fp").alias("a"), F.col("h.fp").alias("b"))
    pairs = still_apart(pairs.distinct(), connected_components(links))
    links = links.unionByName(materialize(verified(pairs, sets), "links"))
    now = met.join(connected_components(links).withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    apart = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    members = materialize(now.join(apart, "key"), "members")
    discard(met)
    pairs = small_pairs(members).unionByName(large_pairs(members, sets)).distinct()
    links = links.unionByName(materialize(verified(pairs, sets), "links"))
    discard(members)
    discard(sets)
    return connected_components(links)


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each group of near copies: the one with the smallest id, then the least text hash.

    Rows without an id come last, so they stay only where no near copy has one;
    repeated rows are copies; rows that repeat an id with other texts are judged
    by their texts; blank and null texts are copies of each other; a text of
    fewer than five words is one shingle and very long texts are read whole;
    other columns stay, whatever their names; an empty table gives no rows.
    """
    counted = shingle_counts(docs.select(text_col))
    prefixes = materialize(with_prefixes(docs, counted, id_col, text_col), "prefixes")
    marked = materialize(prefixes.select("id", "text_hash", "fp"), "marks")
    roots = set_roots(prefixes, marked, docs.select(F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("t")))
    return one_row_each(docs, marked, roots, id_col, text_col)
