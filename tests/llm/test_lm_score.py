"""Language-model scoring: base and model scores against plain sums; held-out gain over the base."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import lm_score
from tessera.llm.queries import op4_lm_score

S = "/root/testdata/sf0.01"


def toks(t):
    return (t or "").encode().lower().split() + [b"\n"]


def test_base_and_gain(spark):
    got = op4_lm_score(spark, S).toPandas()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{S}/documents.parquet").collect()}
    c = Counter()
    for d, t in docs.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            c.update(toks(t))
    n, v = c.total(), len(c)
    assert set(got.doc_id) == set(docs) and (got.train_tokens == n).all()
    for r in got.itertuples():
        w = toks(docs[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.n_tokens == len(w) and r.n_known == sum(x in c for x in w)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_normalised_and_exact(spark):
    rows = [(1, "a b a c"), (2, "B a"), (3, None), (3, None), (None, "zz é q " * 50), (4, "a b " * 120_000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n long")
    own_n, k = 3, lm_score.SUFFIXES
    scorer, counts = lm_score.fit(docs.select("text").limit(5), vocab=k + 1 + own_n, frequent=5)
    m = scorer.model
    logits = m.before[0][:, None] @ m.words.T + m.before[1][None] @ m.words.T + m.bias
    assert np.allclose(np.log(np.exp(logits).sum(axis=2)), scorer.norms, atol=1e-4)
    got = {(r.doc_id, r.n_tokens): r for r in lm_score.scored(docs, scorer, counts).collect()}
    assert len(got) == 5
    c = {bytes(r.token): r.n for r in counts.collect() if bytes(r.token) != b"\n"}
    own = sorted(scorer.places, key=scorer.places.get)[:own_n]
    assert sorted((c[t] for t in own), reverse=True) == sorted(c.values(), reverse=True)[:own_n]
    kind = lambda x: own_n + zlib.crc32(x[-3:]) % k
    shared = {}
    for t, x in c.items():
        if t not in own:
            shared.setdefault(kind(t), []).append(x)
    for d, t in rows:
        w = toks(t)
        ids = [own.index(x) if x in own else own_n + k if x == b"\n" else kind(x) for x in w]
        want = 0.0
        for i, x in enumerate(w):
            a, b = (ids[i - j] if i >= j else own_n + k for j in (1, 2))
            want += float(logits[a, b, ids[i]] - scorer.norms[a, b]) / math.log(10)
            if x not in own and x != b"\n":
                others = shared.get(ids[i], [])
                want += math.log10((c.get(x, 0) + 0.5) / (sum(others) + 0.5 * (len(others) + 1)))
        assert got[d, len(w)].score == pytest.approx(want, rel=1e-4)


def test_score_depends_on_the_rows_alone(spark):
    """Whatever the files and tasks, with one trainer and with several; copies of one text are dealt apart."""
    rnd = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in rnd.integers(0, 300, 60))) for i in range(120)] + [(1000 + i, "the same text again " * 20) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for tokens in (10**6, 3000):
        found = []
        for parts in (1, 4, 16):
            scorer, counts = lm_score.fit(docs.repartition(parts), train_tokens=tokens)
            found.append(sorted((r.doc_id, round(r.score, 4)) for r in lm_score.scored(docs.limit(60), scorer, counts).collect()))
        assert found[0] == found[1] == found[2]


def test_held_out_gain_with_many_trainers(spark):
    docs = spark.read.parquet(f"{S}/documents.parquet").select("doc_id", "text")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    gain = {}
    for tokens in (10**7, 20_000):
        scorer, counts = lm_score.fit(docs.where(~held), train_tokens=tokens)
        r = lm_score.scored(docs.where(held), scorer, counts).selectExpr("sum(score) / sum(n_tokens) s", "sum(base_score) / sum(n_tokens) b").first()
        gain[tokens] = r.s - r.b
    assert gain[10**7] > 0.2 and gain[20_000] > 0.08, gain


def test_equal_counts_fill_the_list(spark):
    counts = spark.createDataFrame([(bytes(f"t{i}", "ascii"), 0, 7) for i in range(50)] + [(b"most", 0, 100), (b"least", 0, 1)], "token binary, class int, n long")
    for most in (1, 2, 30, 51, 52, 60):
        got = lm_score.most_frequent(counts, most)
        assert len(got) == min(most, 52) and got[0] == (b"most", 100) and (most > 51) == ((b"least", 1) in got)
    assert lm_score.most_frequent(counts.repartition(7), 30) == lm_score.most_frequent(counts, 30)


def test_more_equal_tokens_than_places(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    scorer, counts = lm_score.fit(docs.select("text"), vocab=lm_score.SUFFIXES + 3, frequent=3)
    r = lm_score.scored(docs, scorer, counts).first()
    assert (r.n_tokens, r.n_known) == (7, 7) and r.base_score == pytest.approx(7 * math.log10(1.5 / (7 + 0.5 * 8)))


def test_joined_pieces_train_as_single_ones(monkeypatch):
    """Texts of one trainer are read together, in order, with the contexts of each by itself."""
    monkeypatch.setattr(lm_score, "CHUNK", 40)
    rnd = np.random.default_rng(7)
    pieces = [(t, rnd.integers(0, 9, n).astype("<u2").tobytes()) for t in (0, 0, 3, 4) for n in (1, 2, 1, 3, 30, 60, 5, 2)]
    b = pa.RecordBatch.from_arrays([pa.array([t for t, _ in pieces], pa.int32()), pa.nulls(len(pieces)), pa.nulls(len(pieces)), pa.array([x for _, x in pieces], pa.binary())], names=list("abcd"))
    runs = list(lm_score.trainer_runs(b))
    assert [(t, x) for t, run in runs for x in run] == pieces and 3 < len(runs) < len(pieces)
    for _, run in runs:
        ids = [np.frombuffer(x, "<u2").astype(np.int64) for x in run]
        one = [lm_score.contexts(x, np.zeros(1, dtype=np.int64), 9) for x in ids]
        got = lm_score.contexts(np.concatenate(ids), np.cumsum([0, *map(len, ids[:-1])]), 9)
        assert all((np.concatenate([o[k] for o in one]) == got[k]).all() for k in range(2))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    scorer, counts = lm_score.fit(docs.select("text"))
    assert lm_score.scored(docs, scorer, counts).count() == 0
    assert lm_score.scored(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), scorer, counts).first().n_known == 0
