"""Decontamination against scoring every passage with every item."""

import random

import numpy as np

from tessera.llm import decontaminate as dc


def make(seed=3, n_items=60):
    rnd = random.Random(seed)
    vocab = [f"t{i}" for i in range(150)] + ["the"] * 60 + ["of"] * 30
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 15, 30, 60])))) for i in range(n_items)]
    items += [(900, items[5][1]), (901, None), (902, "?!")]
    docs, planted = [], set()
    for d in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([0, 5, 70, 400]))]
        if d % 3 == 0:
            at, (i, item) = rnd.randint(0, len(w)), rnd.choice(items[:n_items])
            item = item.upper().split()
            if d % 6 == 0:
                item = item[: len(item) // 2]
            else:
                planted.add((d, i))
            w[at:at] = item
        docs.append((d, ", ".join(w)))
    return items, planted, [*docs, (500, None), (501, ""), (None, docs[3][1]), (502, "filler " * 250_000 + items[8][1])]


def all_scores(index, words):
    ids = [index.terms.get(w, -1) for w in words]
    out = {}
    for t in set(ids) - {-1}:
        for i, s in zip(*index.postings[t][:2], strict=True):
            out[int(i)] = out.get(int(i), 0) + float(s)
    return out


def test_wand_equals_full_scoring():
    items, planted, docs = make()
    index = dc.ItemIndex(items)
    for _, t in docs[:120]:
        w = dc.words_of(t)[:64]
        terms = sorted({index.terms[x] for x in w if x in index.terms})
        for least in (0.2, 0.5, 0.9):
            want = {i: round(s, 6) for i, s in all_scores(index, w).items() if s >= least - 1e-9}
            assert {i: round(s, 6) for i, s in index.search(terms, least)} == want


def brute(items, docs):
    index = dc.ItemIndex(items)
    out = set()
    for d, t in docs:
        w = dc.words_of(t)
        for a in range(0, max(1, len(w) - dc.PASSAGE + dc.STRIDE), dc.STRIDE) if len(w) < 10_000 else [len(w) - 40]:
            part = w[a : a + dc.PASSAGE]
            for i, s in all_scores(index, part).items():
                i = index.owner[i]
                n, q, r = index.parts[i]
                near = w[max(0, a - n) : a + dc.PASSAGE + n]
                held = []
                for x in (q, r):
                    k = min(5, max(1, len(x)))
                    own = {tuple(x[j : j + k]) for j in range(len(x) - k + 1)}
                    there = {tuple(near[j : j + k]) for j in range(len(near) - k + 1)}
                    held.append(len(own & there) / len(own) if own else 1.0)
                if s >= dc.THRESHOLD - 1e-9 and min(held) >= dc.OVERLAP:
                    out.add((d, index.ids[i]))
    return out


def test_query_equals_brute_force(spark):
    items, planted, docs = make()
    d = spark.createDataFrame([(*x, 1.0) for x in docs], "doc_id long, text string, score double")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = brute(items, docs)
    assert planted | {(502, 8)} <= want
    got = dc.contaminated(d, i).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    clean = dc.without_contaminated(d, i)
    assert clean.columns == d.columns
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(x) for x, _ in docs if x not in {a for a, _ in want})
    assert dc.contaminated(d.limit(0), i).count() == 0 and dc.contaminated(d, i.limit(0)).count() == 0


def test_items_in_several_indexes(spark):
    rnd = np.random.default_rng(0)
    items = [(i, " ".join(f"q{x}" for x in rnd.integers(0, 5000, 20))) for i in range(90)]
    docs = spark.createDataFrame([(i, f"some text {t} more") for i, t in items[::2]], "doc_id long, text string")
    got = dc.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), items_max=25)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i, _ in items[::2]]


def test_scores_do_not_depend_on_how_items_are_dealt(spark):
    """Items of unequal length with shared words, ties among equal items, near misses."""
    rnd = random.Random(8)
    word = lambda: f"w{min(int(rnd.expovariate(0.02)), 400)}"
    items = [(i, " ".join(word() for _ in range(rnd.choice([4, 15, 30, 90])))) for i in range(80)] + [(200, "a tie of two items"), (201, "a tie of two items"), (202, None), (203, "")]
    docs = []
    for i, t in items:
        w = (t or "").split()
        if w:
            w[rnd.randrange(len(w))] = word()
        docs.append((i, " ".join(word() for _ in range(50)) + " " + " ".join(w)))
    docs = spark.createDataFrame([*docs, (900, None), (900, None)], "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    key = lambda rows: sorted((r.doc_id, r.item_id, round(r.score, 9), r.question, r.answer) for r in rows)
    whole = key(dc.contaminated(docs, items).collect())
    assert len(whole) > 40
    for most in (20, 7):
        assert key(dc.contaminated(docs, items, items_max=most).collect()) == whole
    left = {r.doc_id for r in dc.without_contaminated(docs, items, items_max=20).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {d for d, *_ in whole}


def test_one_edited_word_at_every_position():
    rnd = random.Random(11)
    items = [(n, [f"q{rnd.randrange(3000)}" for _ in range(n)]) for n in (15, 22, 31, 44, 59)]
    index = dc.ItemIndex([(i, " ".join(w)) for i, w in items])
    texts, want = [], []
    for i, w in items:
        for at in range(len(w)):
            edited = [*w[:at], "edited", *w[at + 1 :]]
            left = [x for x in range(len(w) - 4) if not x <= at < x + 5]
            if len(left) >= 0.8 * (len(w) - 4):
                texts.append(" ".join([f"f{rnd.randrange(9999)}" for _ in range(rnd.randrange(80))] + edited + ["after"] * 40))
                want.append([i])
    assert len(want) > 100
    assert [[m[0] for m in found] for found in index.matches(texts)] == want
