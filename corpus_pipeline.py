"""The pipeline over `documents`: each stage is written as Parquet and read by the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetally.llm import bpe, mixing, simhash, substring_dedup, toxicity
from pagetally.llm.common import stored
from pagetally.llm.queries import MIX, PATTERN, VOCABULARY, table

#: Words of a shingle of the fingerprints, and the differing bits that still make a near copy, as
#: the operator's own query has them.
SHINGLE, RADIUS = 3, 3
WINDOW = 13


def _aside(docs: DataFrame, *used: str) -> DataFrame:
    """Columns that an operator does not use, packed, so that no name can clash with its own."""
    others = [F.col(c) for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*others, F.lit(0).alias("#")).alias("#others"))


def _back(docs: DataFrame, used: dict[str, object]) -> list:
    """The columns of docs in order: the given ones, and the packed ones."""
    return [used[c].alias(c) if c in used else F.col("#others")[c].alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of classifiers rejects as toxic go; learnt from `labels`."""
    return toxicity.accepted(docs, toxicity.fit_labels(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.representatives(docs, SHINGLE, RADIUS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out. Texts without any stay as they are; of
    the others the words left are parted by single blanks, and n_chars follows."""
    left = substring_dedup.dedup(_aside(docs, "doc_id", "text"), WINDOW)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    used = {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in docs.columns:
        length = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        used["n_chars"] = F.when(cut, length).otherwise(F.col("#others")["n_chars"])
    return left.select(*_back(docs, used))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources of few tokens come up to twice; every document comes at least once."""
    mixed = mixing.mixture(_aside(docs, "doc_id", "source", "text"), MIX)
    return mixed.select(*_back(docs, {c: F.col(c) for c in ("doc_id", "source", "text")}))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, packed, and digests of them and of what they decode to."""
    encoded = bpe.encode(docs, VOCABULARY, PATTERN, keep=("source", "lang"), back=True)
    return bpe.with_digests(encoded).drop("decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Classifiers, fingerprints and encoders are not for SQL; brute force checks the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
