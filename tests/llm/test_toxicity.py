"""Toxicity: held-out accuracy, and the parts against plain definitions."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from tessera.llm import boosting, toxicity
from tessera.llm.queries import op6_toxicity

S = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = op6_toxicity(spark, S).toPandas()
    docs = spark.read.parquet(f"{S}/documents.parquet")
    assert len(got) == docs.count() and got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    got = got.merge(spark.read.parquet(f"{S}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hit / held.toxic.sum() >= 0.9 and hit / max(1, held.predicted.sum()) >= 0.9


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "you idiot", 0.5), (3, "x" * 200_000, 0.5), (3, "x" * 200_000, 0.5)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1), (3, 0), (99, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        assert toxicity.scored(docs, toxicity.fit(docs, labels)).count() == 5
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), some)).count() == 0


def test_lexicon_and_features_equal_plain_counts(spark):
    """The lexicon counted in tasks, and the features read off it, against definitions worked out here."""
    rnd = random.Random(6)
    mild, harsh = [f"word{i}" for i in range(60)], ["grumbleton", "blastard", "zonk"]
    rows = []
    for i in range(400):
        y = i % 4 == 0
        w = [rnd.choice(mild) for _ in range(30)] + ([rnd.choice(harsh), "you"] if y or rnd.random() < 0.02 else [])
        rnd.shuffle(w)
        rows.append((i, " ".join(w) + rnd.choice([".", "!!"]), int(y)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    fit = [(t, y) for i, t, y in rows if zlib.crc32(f"c{i}".encode()) % toxicity.CALIBRATE]
    n1 = sum(y for _, y in fit)
    n0 = len(fit) - n1
    want = {}
    for w in {x for t, _ in fit for x in re.findall(r"[^\W\d_]+", t.lower())}:
        a, b = (sum(w in re.findall(r"[^\W\d_]+", t.lower()) for t, y in fit if y == k) for k in (1, 0))
        if a >= 4 and a * n0 > b * n1:
            p = (a + b) / len(fit)
            g = 2 * (a * math.log(a / n1 / p) + (b * math.log(b / n0 / p) if b else 0))
            odds = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
            if g >= 18 and odds >= 1.5:
                want[w] = odds
    assert model.features.words == pytest.approx(want) and set(harsh) <= set(want)
    text = "You ZONK, you zonk! b@dly LOUD SHOUTING soooo 12 grumbletons"
    got = dict(zip(toxicity.FEATURES, model.features.row(text), strict=True))
    words = re.findall(r"[^\W\d_]+", text.lower())
    hits = [i for i, w in enumerate(words) if w in want]
    begun = [i for i, w in enumerate(words) if w not in want and any(w[:n] in model.features.prefixes for n in (4, 5, 6))]
    near = sum(any(x in toxicity.SECOND_PERSON for x in words[max(0, i - 5) : i + 6]) for i in hits + begun)
    assert got["density"] == len(hits) / len(words) and got["hits"] == math.log1p(len(hits)) and got["near_you"] == near / len(words)
    assert got["capitals"] == sum(c.isupper() for c in text) / len(text) and got["exclaims"] == text.count("!") / len(text)
    assert got["digits"] == 2 / len(text) and got["runs"] == 1 / len(words) and got["peak"] == max(want[words[i]] for i in hits)


def test_isotonic_is_the_least_squares_rise():
    rng = np.random.default_rng(2)
    raw = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    places, values = boosting.isotonic(raw, y, prior=0.0)
    assert (np.diff(values) >= 0).all() and abs(boosting.calibrated(raw, places, values).sum() - y.sum()) < 1e-6


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    t = boosting.BoostedTrees().fit(x[:2000], y[:2000])
    assert ((t.raw(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95
