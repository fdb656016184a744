"""Mixing: targets against a plain loop, conservation, permutations."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(w[s] for s in names if s not in full)
        t = {s: most * sizes[s] if s in full else left * w[s] / rest for s in names}
        more = {s for s in names if s not in full and t[s] > most * sizes[s]}
        if not more:
            return t
        full |= more


def corpus():
    rnd = random.Random(5)
    rows = []
    for i in range(1500):
        src = rnd.choice(["a", "a", "a", "b", "c", "Z", "é", None, "d", "e"])
        rows.append((i, " ".join(f"w{i}x{j}" for j in range(rnd.choice([0, 1, 20, 100, 400]))), src))
    return rows + [(5000, None, "a"), (None, "some words", "b"), (None, None, None), (7000, "\n", "tiny"), (7001, "one", "tiny2")]


def test_targets_and_taken(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.taken_words(docs).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes)
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(3 * mixing.BLOCK, 0.03 * want[s]), (s, taken[s], want[s])
    again = mixing.taken_words(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_documents_hold_the_taken_words(spark):
    rows = [r for r in corpus() if r[0] is not None]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, source string, n_chars long")
    taken = {r.doc: r.taken for r in mixing.taken_words(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    texts = {i: set((t or "").split()) for i, t, _ in rows}
    got = out.collect()
    assert {r.doc_id for r in got} == {d for d, n in taken.items() if n}
    for r in got:
        w = r.text.split()
        assert len(w) == taken[r.doc_id] and max(Counter(w).values()) <= 2 and set(w) <= texts[r.doc_id] and r.n_chars == len(r.text)


def test_permutation(spark):
    for n in (1, 2, 3, 10, 97, 1000, 4097):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("s"), F.lit(1)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))
        if n == 1000:
            assert sum(abs(a.p - b.p) < 50 for a, b in zip(got, got[1:], strict=False)) < 200


def test_one_source_and_no_words(spark):
    docs = spark.createDataFrame([(i, "a b c d " * i, "s") for i in range(40)], "doc_id long, text string, source string")
    got = mixing.taken_words(docs).collect()
    assert all(r.taken <= 2 * r.size for r in got) and abs(sum(r.taken for r in got) - 4680) <= 100
    docs = spark.createDataFrame([(1, None, "s"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.taken_words(docs).collect()] == [(0, 0.0, 0)] * 2


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.taken_words(docs).count() == 0


def test_every_slot_of_every_shard_is_filled_once(spark):
    sizes = {"a": 9000, "b": 70, "c": 33, None: 400, "d": 5000}
    targets = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    total = sum(r.target for r in targets.collect())
    for width in (7, 40, 4096):
        got = mixing.draw_slots(targets, shard_slots=width).collect()
        slots = -(-int(np.ceil(total)) // mixing.BLOCK)
        per = Counter(r.shard for r in got)
        assert len(got) == slots and per == Counter(s // width for s in range(slots))
        assert len({(r.source, r.epoch, r["index"]) for r in got}) == slots
        assert all(r.epoch < 2 and 0 <= r["index"] < -(-sizes[r.source] // mixing.BLOCK) for r in got)


def test_repeated_rows_and_ids(spark):
    text, long = " ".join(f"w{i}" for i in range(64)), " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, text, "s", 0), (1, text, "s", 0), (1, "other " * 40, "s", 0), (None, text, "s", 0), (None, text, "s", 0), (None, "a b c", None, 0), (2, long, "t", 0), (2, None, "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    taken = mixing.taken_words(docs)
    out = mixing.mixed_documents(docs).collect()
    assert sum(len(r.text.split()) for r in out) == sum(r.taken for r in taken.collect())
    for r in out:
        had = max(len(t.split()) for d, t, *_ in rows if d == r.doc_id and t and t.split()[0] == r.text.split()[0])
        assert len(r.text.split()) <= 2 * had and max(Counter(r.text.split()).values()) <= (80 if "other" in r.text else 2)
    assert Counter(r.doc_id for r in out)[1] <= 3
    same = [len(r.text.split()) for r in mixing.mixed_documents(docs.where("text is not null").repartition(3)).collect()]
    assert sorted(same) == sorted(len(r.text.split()) for r in out)


def test_no_plan_holds_all_steps(spark):
    docs = spark.createDataFrame([(*r, 0) for r in corpus()], "doc_id long, text string, source string, n_chars long")
    for out, most in ((mixing.mixed_documents(docs), 10), (mixing.taken_words(docs), 10)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= most and "Range" not in plan, plan.count("Exchange")
