"""The pipeline, stage by stage, against plain code."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import decontaminate as dc
from tessera.llm import quality_rules

from .test_near_copies import jaccard
from .test_near_copies import plain as shingles
from .test_quality_rules import plain

S = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{S}/documents.parquet")
    whole = {r.doc_id: r for r in docs.collect()}
    (_, quality), (_, near), (_, leaks), (_, mix), (_, tokens) = corpus_pipeline.STAGES

    got = quality(spark, docs, S).cache()
    assert got.columns == docs.columns
    one = {r.doc_id for r in got.collect()}
    trusted = {r.doc_id for r in spark.read.parquet(f"{S}/labels.parquet").where("quality = 1").collect()}
    ratio = {r.doc_id: r.ratio for r in quality_rules.judged(docs, spark.read.parquet(f"{S}/labels.parquet").where("quality = 1")).collect()}
    n = {d: plain(r.text) for d, r in whole.items()}
    least = np.percentile([ratio[d] for d in whole if d in trusted and n[d][0] >= 50], 100 * quality_rules.LOW) - quality_rules.MARGIN
    assert one == {d for d in whole if n[d][0] >= 50 and 100 * n[d][4] <= 50 * n[d][0] and ratio[d] >= least}

    got = near(spark, got, S).cache()
    two = {r.doc_id for r in got.collect()}
    sets = {d: shingles(whole[d].text) for d in one}
    root = {d: d for d in one}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in one:
        for b in one:
            if a < b and jaccard(sets[a], sets[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got.columns == docs.columns and two == {d for d in one if root[d] == d}

    got = leaks(spark, got, S).cache()
    three = {r.doc_id for r in got.collect()}
    items = [dc.words_of(r.text) for r in spark.read.parquet(f"{S}/benchmark.parquet").collect()]
    held = {d for d in two if any(f" {' '.join(w)} " in f" {' '.join(dc.words_of(whole[d].text))} " for w in items)}
    assert got.columns == docs.columns and three == two - held

    got = mix(spark, got, S).cache()
    assert got.columns == docs.columns
    four = {r.doc_id: r for r in got.collect()}
    assert set(four) <= three
    for d, r in four.items():
        had, has = Counter(whole[d].text.split()), Counter(r.text.split())
        assert all(has[w] <= 2 * had[w] for w in has) and r.n_chars == len(r.text)
    size = sum(len(whole[d].text.split()) for d in three)
    assert abs(sum(len(r.text.split()) for r in four.values()) - 1.5 * size) < 0.05 * size

    got = tokens(spark, got, S).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at = 0
    for r in sorted(got, key=lambda r: r.doc_id):
        ids = [*t.encode(four[r.doc_id].text, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == len(four)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 3 + " ".join(f"w{i}x{j}" for j in range(80)), "en", f"s{i % 2}", 9, 1.5, "k", i) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long, ratio double, kept string, epoch int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, S)
    assert docs.columns[-3:] == ["ratio", "kept", "epoch"] and {r.kept for r in docs.collect()} == {"k"}
