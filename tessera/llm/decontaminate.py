"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap of question and answer."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize

#: BM25 constants.
K1, B = 1.2, 0.75
#: A training passage has PASSAGE words; the next one begins STRIDE words later.
PASSAGE, STRIDE = 64, 16
#: Longer items are indexed in units of at most so many words; a unit stands nearly whole in some passage.
UNIT = 64
#: A passage retrieves every unit of which it covers this part of the unit's score with itself.
THRESHOLD = 0.7
#: Words of a shingle, and the part of the shingles of question and of answer, or of the whole item, that a document must hold.
SHINGLE, OVERLAP = 5, 0.8
#: The last part of an item's words is its answer.
ANSWER_PART = 0.2
#: Units of a postings block; groups of units for the two bounds.
BLOCK, COARSE, FINE = 8, 24, 240
#: Items and characters of items of one index, about; beyond, there are more indexes, each read against all documents.
#: All share the statistics of all items, so a score does not depend on how items are dealt.
ITEMS_MAX, CHARS_MAX = 5_000, 4_000_000
#: Words that are bounded at once.
CHUNK = 100_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def part_held(part: list[str], near: list[str]) -> float:
    """The part's shingles that stand in near; a part shorter than a shingle stands there whole or not."""
    if len(part) < SHINGLE:
        return float(f" {' '.join(part)} " in f" {' '.join(near)} ") if part else 1.0
    own = shingles(part)
    return len(own & shingles(near)) / len(own)


class Cursor:
    """A term's postings: items ascending, with the largest impact of each block and of all."""

    __slots__ = ("at", "impacts", "items", "most", "peaks")

    def __init__(self, items: np.ndarray, impacts: np.ndarray, peaks: np.ndarray, most: float):
        self.items, self.impacts, self.peaks, self.most, self.at = items, impacts, peaks, most, 0

    @property
    def item(self) -> int:
        return int(self.items[self.at]) if self.at < len(self.items) else 1 << 60

    def seek(self, item: int) -> None:
        self.at += int(np.searchsorted(self.items[self.at :], item))

    def block(self, item: int) -> tuple[float, int]:
        """The peak of the block in which item would stand, and that block's last item; the cursor stays."""
        at = self.at + int(np.searchsorted(self.items[self.at :], item))
        if at >= len(self.items):
            return 0.0, 1 << 60
        b = at // BLOCK
        return float(self.peaks[b]), int(self.items[min(len(self.items), (b + 1) * BLOCK) - 1])


def units_of(words: list[str]) -> list[list[str]]:
    """An item's words in units of nearly equal length, at most UNIT words each."""
    n = -(-len(words) // UNIT)
    edges = [round(j * len(words) / n) for j in range(n + 1)] if n else []
    return [words[x:y] for x, y in zip(edges, edges[1:], strict=False)]


class Statistics:
    """Of all units: how many there are, their mean length, and in how many each term stands."""

    def __init__(self, units: int, words: int, df: dict[str, int]):
        self.units, self.mean, self.df = units, words / max(1, units), df

    @classmethod
    def of(cls, units: list[list[str]]) -> Statistics:
        return cls(len(units), sum(map(len, units)), Counter(t for w in units for t in set(w)))


class ItemIndex:
    """An inverted index of test items; impacts are parts of an item's BM25 score with itself."""

    def __init__(self, items: list[tuple[object, str]], statistics: Statistics | None = None):
        kept = [(i, w) for i, t in items if (w := words_of(t))]
        self.ids = [i for i, _ in kept]
        self.parts = []
        units: list[list[str]] = []
        self.owner: list[int] = []
        for k, (_, w) in enumerate(kept):
            cut = len(w) - max(1, round(len(w) * ANSWER_PART)) if len(w) > 1 else len(w)
            self.parts.append((len(w), w[:cut], w[cut:]))
            cuts = units_of(w)
            units += cuts
            self.owner += [k] * len(cuts)
        n = len(units)
        all_ = statistics or Statistics.of(units)
        df, total, mean = all_.df, all_.units, all_.mean
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(t for w in units for t in w))}
        posting: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for i, w in enumerate(units):
            score = {t: math.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean)) for t, f in Counter(w).items()}
            whole = sum(score.values())
            for t, s in score.items():
                posting[self.terms[t]].append((i, s / whole))
        self.postings = []
        # bounds: a term's largest impact in each group of units
        self.coarse, self.fine = (np.zeros((len(self.terms), -(-n // max(1, -(-n // g))) if n else 1), dtype=np.float32) for g in (COARSE, FINE))
        for k, p in enumerate(posting):
            at, impacts = np.array([i for i, _ in p]), np.array([s for _, s in p])
            self.postings.append((at, impacts, np.maximum.reduceat(impacts, np.arange(0, len(p), BLOCK)), float(impacts.max())))
            for peaks, groups in ((self.coarse, COARSE), (self.fine, FINE)):
                np.maximum.at(peaks[k], at // max(1, -(-n // groups)), impacts)

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """Every item whose summed impact of the distinct terms is at least `least`: block-max WAND."""
        cursors = [Cursor(*self.postings[t]) for t in terms]
        least, found = least - 1e-9, []
        while True:
            cursors = sorted((c for c in cursors if c.at < len(c.items)), key=lambda c: c.item)
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c.most
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot].item
            while pivot + 1 < len(cursors) and cursors[pivot + 1].item == item:
                pivot += 1
            blocks = [c.block(item) for c in cursors[: pivot + 1]]
            if sum(b for b, _ in blocks) >= least:
                if cursors[0].item == item:
                    score = sum(float(c.impacts[c.at]) for c in cursors[: pivot + 1])
                    if score >= least:
                        found.append((item, score))
                    item += 1
                for c in cursors[: pivot + 1]:
                    c.seek(item)
            else:
                after = min([e + 1 for _, e in blocks] + [c.item for c in cursors[pivot + 1 : pivot + 2]])
                for c in cursors[: pivot + 1]:
                    c.seek(max(after, item + 1) if c.item <= item else after)

    def passages(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(first word, distinct terms) of the passages of a run of documents that may reach the threshold.

        The first bound sums the coarse peaks of all words of a passage, by
        differences of running sums over the indexed words; the second sums the
        fine peaks of its distinct terms.
        """
        starts = np.concatenate([[0], ends[:-1]])
        count = np.maximum(1, -(-(ends - starts - PASSAGE) // STRIDE) + 1) * (ends > starts)
        first = np.repeat(starts, count) + STRIDE * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        last = np.minimum(first + PASSAGE, np.repeat(ends, count))
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        held = ids[ids >= 0]
        sums = np.zeros((len(held) + 1, self.coarse.shape[1]))
        np.cumsum(self.coarse[held], axis=0, dtype=np.float64, out=sums[1:])
        low, high = known[first], known[last]
        for k in np.flatnonzero((sums[high] - sums[low]).max(axis=1) >= THRESHOLD - 1e-4).tolist():
            terms = np.unique(held[low[k] : high[k]])
            if self.fine[terms].sum(axis=0).max() >= THRESHOLD - 1e-4:
                yield int(first[k]), terms.tolist()

    def matches(self, texts: list[str | None]) -> Iterator[list[tuple[object, float, float, float]]]:
        """For each text its items: (item, score, part of the question held, part of the answer held)."""
        if not self.ids:
            yield from ([] for _ in texts)
            return
        run, size = [], 0
        for t in texts:
            run.append(words_of(t))
            size += len(run[-1])
            if size >= CHUNK:
                yield from self._matches(run)
                run, size = [], 0
        yield from self._matches(run)

    def _matches(self, docs: list[list[str]]) -> Iterator[list[tuple[object, float, float, float]]]:
        out: list[dict[int, tuple[float, float, float]]] = [{} for _ in docs]
        pieces = [(d, at, w[at : at + CHUNK + PASSAGE]) for d, w in enumerate(docs) for at in range(0, max(1, len(w)), CHUNK)]
        step = [[]]
        for p in pieces:  # a very long text is bounded in pieces that overlap by a passage
            if step[-1] and sum(len(x[2]) for x in step[-1]) + len(p[2]) > 2 * CHUNK:
                step.append([])
            step[-1].append(p)
        for some in step:
            ids = np.fromiter((i for _, _, w in some for i in map(self.terms.get, w, repeat(-1))), dtype=np.int64)
            if not len(ids):
                continue
            ends = np.cumsum(np.array([len(w) for _, _, w in some], dtype=np.int64))
            for a, terms in self.passages(ids, ends):
                k = int(np.searchsorted(ends, a, side="right"))
                d, base = some[k][0], some[k][1] + a - (int(ends[k - 1]) if k else 0)
                for unit, score in self.search(terms, THRESHOLD):
                    item = self.owner[unit]
                    n, question, answer = self.parts[item]
                    near = docs[d][max(0, base - n) : base + PASSAGE + n]
                    held = [part_held(question, near), part_held(answer, near)]
                    enough = min(held) >= OVERLAP or part_held(question + answer, near) >= OVERLAP
                    if enough and (item not in out[d] or out[d][item][0] < score):
                        out[d][item] = (score, *held)
        for found in out:
            yield [(self.ids[i], *x) for i, x in sorted(found.items())]


def item_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", items_max: int = ITEMS_MAX) -> Iterator[ItemIndex]:
    """Indexes of at most about items_max items and CHARS_MAX characters each, so that no task or driver holds all items at any size."""
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    parts = max(1, -(-n // items_max), -(-chars // CHARS_MAX))
    if parts == 1:
        yield ItemIndex([(r.i, r.t) for r in rows.orderBy("i", "t").collect()])
        return
    rows = rows.withColumn("p", F.pmod(F.xxhash64("i", "t"), F.lit(parts)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[int, str | None, int, int]] = []
            for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                units = units_of(words_of(t))
                found.append((p, None, len(units), sum(map(len, units))))
                found += [(p, term, k, 0) for term, k in Counter(t for w in units for t in set(w)).items()]
            cols = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["p", "term", "units", "words"])

    terms = materialize(rows.select("p", "t").mapInArrow(count, "p long, term string, units long, words long"), "item-terms")
    units, words = terms.where("term is null").agg(F.sum("units"), F.sum("words")).first()
    named = terms.where("term is not null")
    df = materialize(named.groupBy("term").agg(F.sum("units").alias("df")), "item-df")
    for p in range(parts):
        own = df.join(named.where(F.col("p") == p).select("term"), "term", "left_semi")
        yield ItemIndex([(r.i, r.t) for r in rows.where(F.col("p") == p).orderBy("i", "t").collect()], Statistics(units, words, {r.term: r.df for r in own.collect()}))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", items_max: int = ITEMS_MAX) -> DataFrame:
    """(id, item, score, question, answer) of every document and test item that it holds.

    Documents without a match have no row; null and empty texts and items match
    nothing; very long texts are read whole, in pieces that overlap by a passage;
    equal items all match, and so do items of equal score; repeated documents
    give repeated rows; other columns, whatever their names, are not read; an
    empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"{id_col} {kinds[0]}, {item_col} {kinds[1]}, score double, question double, answer double"
    item_type = to_arrow_type(items.schema[item_col].dataType)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    out = None
    for index in item_indexes(items, item_col, item_text_col, items_max):

        def run(batches: Iterator[pa.RecordBatch], index=spark.sparkContext.broadcast(index)) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [(d, *m) for d, found in zip(b.column(0).to_pylist(), index.value.matches(b.column(1).to_pylist()), strict=True) for m in found]
                if rows:
                    kinds = [b.column(0).type, item_type, *[pa.float64()] * 3]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[id_col, item_col, "score", "question", "answer"])

        part = source.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", items_max: int = ITEMS_MAX) -> DataFrame:
    """The rows of docs that hold no test item, with all their columns; no shuffle.

    Null and empty texts hold nothing and stay; repeated rows stay or go alike;
    an empty table of items leaves all rows, an empty table of docs gives none.
    """
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    for index in item_indexes(items, item_col, item_text_col, items_max):

        def run(batches: Iterator[pa.RecordBatch], index=spark.sparkContext.broadcast(index)) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not found for found in index.value.matches(b.column(at).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
