"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash


def plain_fingerprint(text, width=4):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in w).split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, max_bits=4, each=False):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    if each:  # one for each component, also where components share an id or have none
        return sorted(str(least.get(k)) for k in {find(i) for i in range(len(rows))})
    return sorted((str(d), fps[i], str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def sample():
    rnd = random.Random(7)
    vocab = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(40):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(1, 120))]
        for _ in range(rnd.choice([1, 1, 2, 5])):
            t = list(base)
            if len(t) > 30 and rnd.random() < 0.7:
                t[rnd.randrange(len(t))] = "changed"
            rows.append((i, rnd.choice([" ", "\n", "\t "]).join(t)))
            i += 1
    return rows + [(900, None), (901, ""), (902, " \x0b"), (None, "lone words here"), (3, "a"), (3, "a"), (950, "one very long " * 30000)]


def test_fingerprint_equals_definition():
    for _, t in sample():
        assert simhash.fingerprint(None if t is None else t.encode()) == plain_fingerprint(t)


def test_query_equals_brute_force(spark):
    rows = sample()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.id), r.fp % (1 << 64), str(r.component_id)) for r in got) == brute(rows)
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == brute(rows, each=True)


def test_rows_without_id_stay_where_nothing_links_them(spark):
    texts = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(5)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[2]), (8, texts[3]), (8, texts[4])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    want = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (8, texts[3]), (8, texts[4])]
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(str, want))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0


def test_every_close_pair_is_connected_on_all_paths(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(12):
            x = int(b)
            for k in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(k)
            fps.add(x)
    df = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")

    def classes(links):
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[find(a)] = find(b)
        groups = {}
        for x in fps:
            groups.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, groups.values()))

    want = classes([(a, b) for a in fps for b in fps if bin(a ^ b).count("1") <= 4])
    for limits in ({}, {"pairwise": 4}, {"pairwise": 4, "group_max": 8}):
        links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.fingerprint_links(df, **limits).collect()]
        assert all(bin(a ^ b).count("1") <= 4 for a, b in links)
        assert classes(links) == want


def test_hash_is_sparks(spark):
    row = spark.sql("select xxhash64('aé b') x").first()
    assert row.x % (1 << 64) == xxhash.xxh64_intdigest("aé b".encode(), 42)
    assert spark.range(1).select(simhash.hex16(F.lit(-1))).first()[0] == "f" * 16
