"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, lm_score, mixing, pii, quality_rules, simhash, token_files, toxicity, url_filter
from .common import read_table


def crc32_fold(folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule, verdict and score.  A null url has an empty host and path; repeated rows give repeated rows; an empty table gives none."""
    return url_filter.judged(read_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's size, its source's size and target, and the words that the mix takes of it.  Null texts have size 0, a null source is a source; repeated rows are rows of their own."""
    taken = mixing.taken_words(read_table(spark, sf_dir, "documents"))
    return taken.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds; no row for a document without one.  Null and empty texts hold nothing."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores under a model of the training folds.  Null texts are their end alone; a null id is in fold 0, which trains; without training rows all words are unknown."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer, counts = lm_score.fit(docs.where(crc32_fold(5) != 1))
    found = lm_score.scored(docs, scorer, counts)
    return found.select("doc_id", (crc32_fold(5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(scorer.total).cast("long").alias("train_tokens"), "base_score", "score")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and number -1, as read back from its formatted text.  Null texts are empty; a null conv_id is one conversation; repeated rows stay, in an order of their own."""
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_conversations(chat.format_conversations(rows)).drop("rank")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's calibrated score.  Null and empty texts are scored like any other; a null id is in fold 0, which trains if it has a label."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(crc32_fold(4) != 2))
    found = toxicity.scored(docs, model)
    return found.select("doc_id", (crc32_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and digest, read back from token files.  Null texts are their end id alone; null ids come first; repeated ids stand together."""
    return token_files.encode_and_read(read_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's spans: the patterns' in counts and digest, all in spans.  Null texts have none."""
    docs = read_table(spark, sf_dir, "documents")
    found = pii.detected(docs, pii.fit(docs))
    rank = lambda s: F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"])

    def listed(spans: str) -> Column:
        ordered = F.sort_array(F.transform(spans, lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest id of its component.  Null and blank texts have fingerprint zero; null ids get their component's smallest."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, base verdict and verdict.  Null texts have no words and fail; trusted documents are those with label quality 1."""
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    found = quality_rules.judged(read_table(spark, sf_dir, "documents").select("doc_id", "text"), trusted)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_mixing": op2_mixing,
    "op3_decontaminate": op3_decontaminate,
    "op4_lm_score": op4_lm_score,
    "op5_chat": op5_chat,
    "op6_toxicity": op6_toxicity,
    "op7_token_files": op7_token_files,
    "op8_pii": op8_pii,
    "op9_simhash": op9_simhash,
    "op10_quality_rules": op10_quality_rules,
}

#: The others need XXH64, a tokenizer or a trained model, which DuckDB lacks.
ORACLE_SQL: dict[str, str] = {
    "op5_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
escaped AS (
  SELECT *, length(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))
    + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))
    + length(role) - length(replace(role, chr(10), '')) + length('<|im_start|>') + 1 + length('<|im_end|>') + 1 AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
""",
}
