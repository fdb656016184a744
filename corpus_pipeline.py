"""The corpus pipeline: filter, deduplicate, decontaminate, mix and encode documents.

Each stage takes the rows that its predecessor kept and returns the columns of
documents, but for the last, which returns where each document's token ids are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, near_copies, quality_rules, token_files
from tessera.llm.common import discard, materialize, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and short texts go; repeated rows stay or go alike; equal ratios are
    judged alike; very long texts are read whole; an empty table stays empty.
    """
    return quality_rules.kept(docs, read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) one row stays.

    It is the one with the smallest id, null last, then the least text hash;
    repeated rows are copies; null and blank texts are copies of each other.
    """
    return near_copies.keep_representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none; items of equal score all count; with no
    items every row stays.
    """
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become the words that the mixture takes of them, at most twice; documents of which it takes none go.

    Null and blank texts go; a null source is a source; repeated rows are mixed
    as rows of their own.
    """
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files with a keyed index; a row for each document as read back.

    Null ids come first, repeated ids together; a null text is its end id.
    """
    return token_files.encode_and_read(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token files", token_stage),
]

#: Fingerprints, trained tables and a tokenizer have no SQL form; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder before the next reads it.

    A stage's input goes once its output is written.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
