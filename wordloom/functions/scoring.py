"""Score factors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.config import DEFAULT_WEIGHTING, WEIGHT_FACTORS, WEIGHT_LABELS

# Robertson & Walker (1994) constants.
BM25_K1 = 1.2
BM25_B = 0.75


def weight_factor(weighting: Column) -> Column:
    """4, 2, 1, 0.5, 0.25 for weighting 0..4; sections without one count as 1."""
    level = F.coalesce(weighting, F.lit(DEFAULT_WEIGHTING))
    table = F.create_map(*[F.lit(x) for pair in WEIGHT_FACTORS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, level), F.lit(1.0))


def weight_label(weighting: Column) -> Column:
    level = F.coalesce(weighting, F.lit(DEFAULT_WEIGHTING))
    table = F.create_map(*[F.lit(x) for pair in WEIGHT_LABELS.items() for x in pair])
    return F.try_element_at(table, level)


def recency_divisor(as_of: Column, created: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(1), F.datediff(as_of, created)).cast("double"))


def bm25(tf: Column, doc_len: Column, avg_len: Column, docs: Column, df: Column) -> Column:
    idf = F.log(1 + (docs - df + 0.5) / (df + 0.5))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * doc_len / avg_len)
    return idf * tf * (BM25_K1 + 1) / (tf + norm)
