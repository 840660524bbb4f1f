"""The registered queries of these operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    bpe,
    exact_dedup,
    fingerprints,
    hard_negatives,
    license_scan,
    minhash_dedup,
    ngram_lm,
    packing,
    secrets,
    sharding,
    spelling,
    toxicity,
    url_filter,
)
from wordloom.llm.common import read
from wordloom.session import shared_folder


def byte_bpe() -> tuple[list[bytes], str]:
    """The public byte-level vocabulary of 50k entries and its pre-token pattern."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.read_ranks(path), public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, pattern = byte_bpe()
    encoded = bpe.encode(read(spark, sf_dir, "documents"), vocabulary, pattern)
    return bpe.digests(bpe.decode(encoded, vocabulary))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(read(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards equal in bytes, from shards that a hash of the source has filled unevenly; the blocks
    that lose documents are written anew."""
    docs = read(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64("source"), F.lit(sharding.SHARDS))
    placed = sharding.reshard_and_rewrite(docs, old, shared_folder(spark, "new-shards"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def packed(docs: DataFrame) -> DataFrame:
    """Sequences of at most 1024 tokens, each document closed by id 0."""
    vocabulary, pattern = byte_bpe()
    pieces = packing.pack(docs, vocabulary, pattern)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read(spark, sf_dir, "documents"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked by sets of two-word shingles."""
    return minhash_dedup.near_copies(read(spark, sf_dir, "documents"), width=2)


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(read(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.secrets(read(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 7th row takes the next label first; components in steps of 1/256."""
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = hard_negatives.quantised(F.col("embedding"), 256)
    return hard_negatives.hard_negatives(
        rows.select("vec_id", moved.alias("label"), vector.alias("vector"))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_sharding": op4_sharding,
    "op5_url_filter": op5_url_filter,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_fingerprints": op8_fingerprints,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_ngram_lm": op10_ngram_lm,
    "op11_spelling": op11_spelling,
    "op12_secrets": op12_secrets,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": license_scan.SCAN_SQL,
    "op3_exact_dedup": exact_dedup.DECISIONS_SQL,
    "op9_minhash_dedup": minhash_dedup.NEAR_SQL,
    "op11_spelling": spelling.VARIANTS_SQL,
    "op13_hard_negatives": hard_negatives.HARD_NEGATIVES_SQL,
}
