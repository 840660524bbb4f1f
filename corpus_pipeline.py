"""The training-data pipeline: toxic documents go, then exact and near copies; the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import exact_dedup, minhash_dedup, toxicity
from wordloom.llm.common import read, stored
from wordloom.llm.queries import packed

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, trained on the labels, does not find toxic."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels")).select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each text."""
    return exact_dedup.drop_copies(docs).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, found by five-word shingles."""
    return minhash_dedup.drop_near_copies(docs).select(*COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packed(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed_sequences),
]

# Neither the learned grammar nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
