"""Quality rules against a plain count, and the ratio against a plain model."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import quality_rules

SPLIT = re.compile("[ \t\n\x0b\x0c\r]+")


def plain(text):
    t = text or ""
    w = [x for x in SPLIT.split(t) if x]
    lines = [x for x in t.split("\n") if SPLIT.sub("", x)]
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def texts():
    rnd = random.Random(2)
    out = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x x", "# $ é🙂 <|>", "l1\nl1\n \n \nl1\r\nl2", "\u00a0 \u3000 a\u00a0b"]
    out += ["word " * 30000, " ".join(f"w{i % 700}" for i in range(5000))]
    for _ in range(60):
        out.append("".join(rnd.choice(["the", "of", "at", "Ün", "###", "|"]) + rnd.choice([" ", "\n", "  "]) for _ in range(rnd.randint(1, 200))))
    return out


def test_counts_equal_definition(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_words string")
    trusted = spark.createDataFrame([(12,), (13,), (None,), (12,)], "doc_id long")
    got = {r.doc_id: r for r in quality_rules.judged(docs, trusted, least_ratio=-0.4).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        want = plain(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, (i, t and t[:50])
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and r.ratio >= -0.4)


def grams(text):
    """The buckets of the tokens and of their neighbour pairs, by hashes worked out here."""
    h = [xxhash.xxh64_intdigest(t.encode(), 42) for t in SPLIT.split(re.sub(r"((?:[^\w \t-\r]|_)+)", r" \1 ", text or "").strip(" \t\n\x0b\x0c\r")) if t]
    mask = quality_rules.BUCKETS - 1
    return [x & mask for x in h] + [((x >> 17) ^ y) & mask for x, y in zip(h, h[1:], strict=False)]


def test_ratio_equals_plain_model(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts()[8:20] * 2) if "\u3000" not in (t or "")] + [(None, "a b"), (9, "a b"), (9, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (4,), (9,), (9,), (None,)], "doc_id long")
    every, good = Counter(), Counter()
    for i, t in rows:
        every.update(grams(t))
        if i in (1, 4, 9):
            good.update(grams(t))
    b, s = quality_rules.BUCKETS, quality_rules.SMOOTH
    ratio = lambda k: math.log((good[k] + s) / (good.total() + s * b)) - math.log((every[k] + s) / (every.total() + s * b))
    want = sorted(sum(map(ratio, g)) / max(1, len(g)) for g in (grams(t) for _, t in rows))
    for sent in (quality_rules.TRUSTED_SENT, 0):  # ids sent to the tasks, or joined
        monkeypatch.setattr(quality_rules, "TRUSTED_SENT", sent)
        assert sorted(r.ratio for r in quality_rules.judged(docs, trusted).collect()) == pytest.approx(want, abs=1e-6)


def test_threshold_lies_under_the_trusted(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(f"g{rnd.randint(0, 40)}" for _ in range(80))) for i in range(60)] + [(100 + i, " ".join(f"b{rnd.randint(0, 40)}" for _ in range(80))) for i in range(60)] + [(300, "g1 g2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality_rules.judged(docs, docs.where("doc_id < 30 or doc_id = 300").select("doc_id")).collect()
    assert {r.doc_id for r in got if r.kept} == set(range(60))
    least = np.percentile([r.ratio for r in got if r.doc_id < 30], 100 * quality_rules.LOW) - quality_rules.MARGIN
    assert all(r.kept == (not r.base_failed and r.ratio >= least) for r in got)
    assert all(r.kept != r.base_failed for r in quality_rules.judged(docs, docs.limit(0).select("doc_id")).collect())


def test_all_trusted_documents_set_the_threshold(spark):
    """More of them than any sample took, the lowest ratios spread thinly."""
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice(["g", "b"] if i % 50 == 0 else ["g"]) + str(rnd.randint(0, 40)) for _ in range(50 + i % 9))) for i in range(9000)] + [(None, "g1 " * 60), (9001, "g1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = docs.where("doc_id % 10 <> 9").select("doc_id")
    table = quality_rules.ratio_table(docs, trusted)
    values = table.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))), lambda x: x["ratio"])).scalar()
    ratios = [r.ratio for r in quality_rules.with_ratio(docs, values, "text").collect() if r.doc_id is not None and r.doc_id % 10 != 9 and r.doc_id < 9000]
    want = np.percentile(ratios, 100 * quality_rules.LOW) - quality_rules.MARGIN
    assert len(ratios) > 8000 and quality_rules.calibrated_ratio(docs, trusted, values, "doc_id", "text") == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("left", [1, 4096])
def test_value_at_equals_sorted(spark, monkeypatch, left):
    monkeypatch.setattr(quality_rules, "LEFT", left)
    rnd = random.Random(8)
    values = [0.0] * 9 + [-0.25] * 5 + [1e-9, 2e-9, -1e-300, 3.0, math.nextafter(3.0, 4)] + [rnd.gauss(0, 2) for _ in range(60)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for rank in (0, 1, 20, 33, 40, 44, 46, 77, 78):
        assert quality_rules.value_at(rows, rank) == sorted(values)[rank]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules.judged(docs, docs.select("doc_id")).count() == 0
