"""Token files: exact round trip and keyed access."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import token_files
from tessera.llm.perfect_hash import PerfectHash


def rows():
    return [(5, "Hello WORLD\n\n it's\x1c naïve co-op 123 <|endoftext|> x"), (-3, ""), (None, "null key"), (9, None), (7, "same"), (7, "same"), (7, "other"), (2**62, "é 🙂 ß " * 5000), (8, "x" * 3000), (10, "J\u030c. I\u0307, A\u030a <|ENDOFTEXT|> \u0130x, \u03a3\u03a3. a,, b... c.\x1c d.\u00a0e x\u00b2. (f), 3. don't. I'LL, _.")]


def plain(rs):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return sorted((str(k), len(i := [*t.encode(x or "", add_special_tokens=False).ids, 2]), zlib.crc32(np.array(i, "<u4").tobytes())) for k, x in rs)


def test_round_trip(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows()], "doc_id long, text string, start int")
    for chars in (100, 10**7):
        got = token_files.encode_and_read(docs, shard_chars=chars).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == plain(rows())
        at = 0
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
        assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))


def test_absent_keys_and_empty(spark, tmp_path):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    made = token_files.write_token_files(docs, f"file://{tmp_path}/t").collect()
    shard = token_files.Shard.open(made[0].base)
    assert made[0].nulls and (made[0].first_key, made[0].last_key, made[0].n_docs) == (-3, 2**62, len(rows()))
    assert [len(x) for x in shard.find(7)] == [2, 2, 2] and shard.find(6) == [] and len(shard.find(None)) == 1
    assert sum(bool(shard.find(k)) for k in range(100, 5000)) == 0
    assert token_files.encode_and_read(docs.limit(0)).count() == 0


def test_lookup_across_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(0, 3000, 3)] + [(None, "no key")], "doc_id long, text string")
    made = token_files.write_token_files(docs, f"file://{tmp_path}/t", shard_chars=20_000).cache()
    assert made.count() > 5
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for k in (0, 3, 1500, 2997, None, 1, 2998, -5, 10**9):
        want = [[*t.encode(f"text number {k}" if k is not None else "no key", add_special_tokens=False).ids, 2]] if k is None or (k % 3 == 0 and 0 <= k < 3000) else []
        assert [x.tolist() for x in token_files.find_documents(made, k)] == want
    read = []
    shard = token_files.Shard.open(made.first().base)
    index, payload = shard.index, shard.payload
    shard.index = lambda at, n: read.append(n) or index(at, n)
    shard.payload = lambda at, n: read.append(n) or payload(at, n)
    assert shard.find(made.first().first_key) and sum(read) < 100


def test_marks_and_cases_equal_the_library():
    """U+0130 lower-cases to a letter and a mark, which a full stop after it joins."""
    rnd = random.Random(3)
    pieces = [*"aAzZ09.,'-_ \n|<>\u0130\u0131\u017f\u212a\u03a3\u03c2\u00df\u1e9e\u00e9\u00c9\u0301\u0307\ufb01\u01c5\u00b2\u00bd", "TATL\u0130, evet", "\u0130.", "\u0130,", "'s", "'LL", "<|endoftext|>"]
    texts = ["TATL\u0130, evet", *("".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9))) + rnd.choice(["", ".", ",", "\n"]) for _ in range(20_000))]
    encoder = token_files.Encoder("word_bpe_49k.json")
    want = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    for t, got, w in zip(texts, encoder.encode(texts), want, strict=True):
        assert np.frombuffer(got, encoder.kind).tolist() == w.ids, t


def test_whole_table_equals_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = token_files.encode_and_read(docs.select("doc_id", "text")).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20000, dtype=np.uint64))
    h = PerfectHash.build(keys)
    assert sorted(PerfectHash.of(*h.arrays()).slot(keys)) == list(range(len(keys)))
