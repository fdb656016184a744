"""Toxicity: boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees, calibrated, isotonic
from .common import hash_sample, materialize

#: Labelled rows that the classifier learns from, at most; the sample is by hash of the id.
TRAIN_MAX = 20_000
#: One of so many training rows calibrates and is not used for lexicon or trees.
CALIBRATE = 4
#: Likelihood-ratio statistic and toxic rows that a lexicon entry needs.
LEAST_G, LEAST_ROWS = 18.0, 4
PREFIXES = (4, 5, 6)
NEAR = 5
THRESHOLD = 0.3
#: Second-person words of the languages read here.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vos".split())
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[a-z][*@$!|0-9]+[a-z]")
_CAPS = re.compile(r"\b[A-Z]{3,}\b")
_RUN = re.compile(r"([a-z])\1\1")
_LEET = str.maketrans("013457@$!|", "oieastasil")
FEATURES = ("density", "hits", "peak", "prefix_density", "prefix_hits", "prefix_peak", "near_you", "masked", "masked_hits", "capitals", "caps_words", "exclaims", "marks", "digits", "symbols", "runs", "words")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def prefixes_of(words: set[str]) -> set[str]:
    return {w[:n] for w in words if len(w) > PREFIXES[0] for n in PREFIXES if len(w) > n}


def entry_kinds(text: str) -> tuple[set[str], set[str]]:
    """The distinct words of a text, and their beginnings."""
    words = set(words_of(text))
    return words, prefixes_of(words)


def weight(a: int, b: int, n1: int, n0: int) -> float | None:
    """The log-odds of an entry in `a` of n1 toxic and `b` of n0 other texts; None if it stands there not far more often."""
    if a < LEAST_ROWS or a * n0 <= b * n1:
        return None
    share = (a + b) / (n0 + n1)
    g = 2 * (a * math.log(a / (n1 * share)) + (b * math.log(b / (n0 * share)) if b else 0))
    odds = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
    return odds if g >= LEAST_G and odds >= 1.5 else None


def lexicon(counts: list[tuple[int, str, int, int]], n1: int, n0: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words (kind 0) and word beginnings (kind 1) that stand in toxic texts far more often, from (kind, entry, toxic, other)."""
    out: tuple[dict[str, float], dict[str, float]] = ({}, {})
    for kind, w, a, b in sorted(counts):
        if (x := weight(a, b, n1, n0)) is not None:
            out[kind][w] = x
    return out


class Features:
    def __init__(self, words: dict[str, float], prefixes: dict[str, float]):
        self.words, self.prefixes = words, prefixes
        self.heads = {p[: PREFIXES[0]] for p in prefixes}

    def prefix_weight(self, w: str) -> float:
        return max((self.prefixes.get(w[:n], 0.0) for n in PREFIXES), default=0.0)

    def row(self, text: str) -> list[float]:
        low = text.lower()
        words = _WORD.findall(low)
        n = max(1, len(words))
        seen = set(words)
        hits = {w: self.words[w] for w in seen & self.words.keys()}
        starts = {w: x for w in seen if w[: PREFIXES[0]] in self.heads and w not in hits and (x := self.prefix_weight(w))}
        count = near = pcount = 0
        if hits or starts:
            at = [i for i, w in enumerate(words) if w in hits or w in starts]
            count = sum(words[i] in hits for i in at)
            pcount = len(at) - count
            near = sum(any(x in SECOND_PERSON for x in words[max(0, i - NEAR) : i + NEAR + 1]) for i in at)
        b = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
        chars = max(1, len(text))
        masked = _MASKED.findall(low) if (b[33] + b[36] + b[42] + b[64] + b[124] + b[48:58].sum()) else []
        clear = sum(w in self.words for w in _WORD.findall(low.translate(_LEET)) if w not in hits) if masked else 0
        caps = b[65:91].sum()
        return [
            count / n, math.log1p(count), max(hits.values(), default=0.0), pcount / n, math.log1p(pcount), max(starts.values(), default=0.0), near / n, len(masked) / n, math.log1p(clear),
            caps / chars, len(_CAPS.findall(text)) / n if caps > 0.1 * chars else 0.0, b[33] / chars, (b[44] + b[46] + b[58] + b[59] + b[63]) / chars, b[48:58].sum() / chars,
            (b[35] + b[36] + b[37] + b[38] + b[42] + b[64] + b[124]) / chars, len(_RUN.findall(low)) / n, math.log1p(len(words)),
        ]

    def matrix(self, texts: list[str]) -> np.ndarray:
        return np.array([self.row(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


class ToxicityModel:
    """Learned from feature rows with labels; deterministic."""

    def __init__(self, features: Features, x: np.ndarray, y: np.ndarray, held: np.ndarray):
        """held: rows that calibrate and are not used for the trees."""
        self.features = features
        fit = ~held if (~held).any() else np.ones(len(y), dtype=bool)
        self.trees = BoostedTrees().fit(x[fit], y[fit])
        self.places, self.values = isotonic(self.trees.raw(x[held]), y[held]) if len(set(y[held])) == 2 else (np.array([]), np.array([]))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return calibrated(self.trees.raw(self.features.matrix([t or "" for t in texts])), self.places, self.values)


def calibrates(id_: object) -> bool:
    return zlib.crc32(f"c{id_}".encode()) % CALIBRATE == 0


def fold(id_: object, folds: int) -> int:
    return zlib.crc32(str(id_).encode()) % folds


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_max: int = TRAIN_MAX) -> ToxicityModel:
    """Learn from at most train_max labelled rows, chosen by hash of the id.

    Labels may hold ids without documents, repeated ids (the highest label
    counts) and nulls (left out); of documents that repeat an id the least text
    counts.  Ids of the sample are bounded by train_max, so they are broadcast.
    No text reaches the driver: tasks count words for the lexicon, of which the
    entries that may pass arrive, and then send a row of features for each text.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("int").alias("y"))
    chosen = spark.createDataFrame(hash_sample(known, train_max, "id").collect(), known.schema)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id").agg(F.min(F.struct("t", "y")).alias("r")).select("id", "r.t", "r.y")  # one row for an id, however often it is repeated
    sample = materialize(rows, "toxicity-sample")
    classes = sample.select("id", "y").collect()
    fitting = [r.y for r in classes if not calibrates(r.id)]
    n1, all_held = sum(fitting), not fitting
    if all_held:
        n1, fitting = sum(r.y for r in classes), [r.y for r in classes]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[int, str, int]] = Counter()
        for b in batches:
            for i, t, y in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if all_held or not calibrates(i):
                    for kind, entries in enumerate(entry_kinds(t)):
                        found.update((kind, w, y) for w in entries)
        cols = list(zip(*[(k, w, n * y, n * (1 - y)) for (k, w, y), n in found.items()], strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["kind", "entry", "toxic", "other"])

    counts = sample.mapInArrow(count, "kind long, entry string, toxic long, other long").groupBy("kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    may = counts.where((F.col("toxic") >= LEAST_ROWS) & (F.col("toxic") * (len(fitting) - n1) > F.col("other") * n1))
    features = Features(*lexicon([tuple(r) for r in may.collect()], n1, len(fitting) - n1))
    shared = spark.sparkContext.broadcast(features)

    def row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [r.tolist() for r in shared.value.matrix(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "x"])

    kind = sample.schema["id"].dataType.simpleString()
    got = sorted(sample.mapInArrow(row, f"id {kind}, y int, x array<double>").collect(), key=lambda r: r.id)
    x = np.array([r.x for r in got], dtype=np.float64).reshape(len(got), len(FEATURES))
    return ToxicityModel(features, x, np.array([r.y for r in got], dtype=np.float64), np.array([calibrates(r.id) for r in got], dtype=bool))


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; no shuffle.

    Null and empty texts are scored like any other, very long ones whole; equal
    texts get equal scores, repeated rows repeated rows, an empty table none;
    other columns, whatever their names, are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(b.column(1).to_pylist()), pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, score double")
