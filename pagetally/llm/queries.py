"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetally.llm import (
    bpe,
    collocations,
    conversation_repair,
    exact_dedup,
    maxent,
    mixing,
    nn_descent,
    quality_fm,
    quality_rules,
    simhash,
    substring_dedup,
    tool_calls,
    toxicity,
)
from pagetally.llm.common import crc_of_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The vocabulary and the pattern of the BPE query.
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digests = bpe.with_digests(bpe.encode(docs, VOCABULARY, PATTERN, back=True))
    return digests.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs.select("doc_id", "text"), toxicity.fit_labels(docs, labels)).drop("text")


def op4_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_of_id() % 5 == 1
    docs = table(spark, sf_dir, "documents")
    scored = maxent.score(docs, training=~held_out)
    return scored.withColumn("held_out", held_out)


#: Flat as far as no source comes more than twice; every document comes at least once.
MIX = mixing.Target(max_repeats=2.0)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixture(docs, MIX).drop("text")


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.calls_of(table(spark, sf_dir, "conversations"))
    linked = tool_calls.link(calls, results, tool_calls.TOOLS)
    return linked.withColumn("problems", F.array_join("problems", ","))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op9_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id() % 3 == 1
    machine = quality_fm.fit_labels(docs, labels.where(~held_out))
    scored = quality_fm.score(docs.select("doc_id", "text"), machine)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substring_dedup.dedup(docs, window=13)
    digest = F.sha2("kept_text", 256).alias("kept_sha256")
    return left.select("doc_id", "n_words", "n_removed", digest)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents")).drop("carried")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    turns = conversation_repair.damaged(conversations)
    plans = conversation_repair.audits(turns, conversations)
    return conversation_repair.with_digest(turns, plans)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_maxent": op4_maxent,
    "op5_mixing": op5_mixing,
    "op6_tool_calls": op6_tool_calls,
    "op7_nn_descent": op7_nn_descent,
    "op8_simhash": op8_simhash,
    "op9_quality_fm": op9_quality_fm,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_collocations": op11_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}
