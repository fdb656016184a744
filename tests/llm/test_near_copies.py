"""Near copies against comparing all pairs of shingle sets."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import components, near_copies, simhash


def plain(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def sample():
    """Texts with planted copies of similarity 0.6 to 1, a large group around one text, chains, and a line that most share."""
    r = random.Random(5)
    line = " ".join(f"common{i}" for i in range(12))
    word = lambda: f"v{r.randrange(5000)}"
    rows = []
    for k in range(60):
        base = [word() for _ in range(r.choice([3, 8, 60, 150, 300]))]
        for _ in range(40 if k == 7 else r.choice([1, 2, 4])):
            t = list(base)
            for _ in range(r.choice([0, 1, 2, 4, 8])):
                t[r.randrange(len(t))] = word()
            rows.append(" ".join(t) + (f"\n{line}" if k % 3 else ""))
    r.shuffle(rows)
    return list(enumerate([*rows, None, "", " \t"]))


def kept(rows):
    sets, root = [plain(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = 0
    for i in range(len(rows)):
        for j in range(i):
            if (x := jaccard(sets[i], sets[j])) >= 0.8:
                near += 0.8 <= x <= 0.95
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert near > 50
    return [rows[i][0] for i in range(len(rows)) if find(i) == i]


@pytest.mark.parametrize("sent", [components.SENT, 0])
def test_stage_equals_all_pairs(spark, monkeypatch, sent):
    monkeypatch.setattr(components, "SENT", sent)
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == kept(rows)


def test_fingerprints_of_all_texts_link_first(spark, monkeypatch):
    """The stage links the SimHash fingerprints of five-word shingles, repeats included; the sets confirm what is united."""
    rows = [*sample(), (900, "again and again " * 30)]
    met, real = [], simhash.fingerprint_links
    monkeypatch.setattr(simhash, "fingerprint_links", lambda fps, *a: met.append(sorted(r.fp for r in fps.collect())) or real(fps, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == kept(rows)
    assert met == [sorted({simhash.signed(simhash.fingerprint((t or "").encode(), 5)) for _, t in rows})]


def test_alike_connects_all_within_the_bits(spark):
    r = random.Random(3)
    bases = [r.getrandbits(64) for _ in range(12)]
    flip = lambda x, k: x ^ sum(1 << b for b in r.sample(range(64), k))
    marks = [(simhash.signed(flip(r.choice(bases), r.choice([0, 0, 1, 2, 3, 5]))), i) for i in range(200)]

    def parts(linked):
        root = list(range(200))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in linked:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(200)]

    pairs = [(i, j) for i in range(200) for j in range(i) if ((marks[i][0] ^ marks[j][0]) & (2**64 - 1)).bit_count() <= near_copies.BITS]
    got = near_copies.alike(spark.createDataFrame(marks, "mark long, fp long")).collect()
    assert parts((x.a, x.b) for x in got) == parts(pairs) and len(got) < len(pairs)


def test_large_groups_by_blocks_equal_all_pairs(spark, monkeypatch):
    """Copies of texts that are not there themselves: many under a key, few of them similar."""
    r = random.Random(9)
    word = lambda: f"v{r.randrange(9000)}"
    rows = []
    for size in (70, 120):
        base = [word() for _ in range(size)]
        for _ in range(60):
            t = list(base)
            for _ in range(r.choice([1, 2, 2, 3])):
                t[r.randrange(size)] = word()
            rows.append(" ".join(t))
    rows = list(enumerate(rows + [" ".join(word() for _ in range(90)) for _ in range(20)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = kept(rows)
    assert 30 < len(want) < len(rows)
    for pairwise, block in ((64, 2048), (4, 16), (1, 7)):
        monkeypatch.setattr(near_copies, "PAIRWISE", pairwise)
        monkeypatch.setattr(near_copies, "BLOCK", block)
        assert sorted(x.doc_id for x in near_copies.keep_representatives(docs).collect()) == want


def test_the_bound_leaves_out_no_similar_pair():
    rng = np.random.default_rng(5)
    for n in (1, 3, 9, 40, 900, 20_000):
        a = np.unique(rng.integers(-(2**62), 2**62, n))
        for drop in (0, n // 20, n // 9):
            b = np.unique(np.concatenate([a[drop:], rng.integers(-(2**62), 2**62, n // 10 if drop else 0)]))
            both = len(np.intersect1d(a, b))
            counts = [np.frombuffer(near_copies.histogram(x), np.uint8)[None] for x in (a, b)]
            i, _ = near_copies.screened((np.array([len(a)]), np.array([1]), counts[0]), (np.array([len(b)]), np.array([2]), counts[1]))
            assert len(i) == 1 or both * 9 < (len(a) + len(b)) * 4


def test_empty(spark):
    assert near_copies.keep_representatives(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("sent", [components.SENT, 0])
def test_rows_without_own_id_stay_apart(spark, monkeypatch, sent):
    monkeypatch.setattr(components, "SENT", sent)
    texts = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (1, texts[2]), (1, texts[3]), (2, texts[3]), (2, texts[4]), (3, texts[5]), (3, texts[5])]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row long")
    want = sorted(map(str, [(None, texts[0]), (None, texts[1]), (1, texts[2]), (1, texts[3]), (2, texts[4]), (3, texts[5])]))
    assert sorted(str((r.doc_id, r.text)) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == want
