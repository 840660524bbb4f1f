"""Scores, order, pages and totals of hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.config import DIRECTIONS, SORTS, SearchConfig
from wordloom.functions.scoring import recency_divisor, weight_factor
from wordloom.session import shuffle_width


def add_weight(hits: DataFrame, index_config: DataFrame) -> DataFrame:
    """Add the ``weight`` of each hit's section; sections without settings weigh 1."""
    settings = index_config.select("section_id", "weighting")
    return hits.join(settings, "section_id", "left").withColumn(
        "weight", weight_factor(F.col("weighting"))
    ).drop("weighting")


def query_settings(queries: DataFrame, cfg: SearchConfig) -> DataFrame:
    """Sort, direction, page and page size of each query, defaults filled in."""
    per_page = F.when(F.col("per_page") > 0, F.col("per_page")).otherwise(cfg.default_per_page)
    direction = F.lower(F.coalesce("direction", F.lit(cfg.default_direction)))
    return queries.select(
        "qid",
        F.coalesce("sort", F.lit(cfg.default_sort)).alias("sort"),
        direction.alias("direction"),
        F.coalesce("page", F.lit(1)).alias("page"),
        per_page.alias("per_page"),
    )


def setting_errors(queries: DataFrame) -> DataFrame:
    """``(qid, error)`` of queries that ask for an unknown sort or direction."""
    sort, direction = F.lower("sort"), F.lower("direction")
    error = F.when(~sort.isin(*SORTS), "Invalid search sort").when(
        ~direction.isin(*DIRECTIONS), "Invalid search direction"
    )
    return queries.select("qid", error.alias("error")).filter("error IS NOT NULL")


def deepest_rank(settings: DataFrame) -> int:
    """The last rank that any query of a batch asks for: one number out of its settings."""
    last = F.greatest(F.lit(0), F.col("page") - 1) * F.col("per_page") + F.col("per_page")
    return settings.agg(F.max(last).alias("last")).first()["last"] or 0


def add_scores(
    hits: DataFrame,
    settings: DataFrame | None,
    index_config: DataFrame,
    dates: DataFrame,
    as_of: Column,
    base: str = "occurrences",
) -> DataFrame:
    """``score`` = base score x section weight, divided by age for ``score-recency``.

    Creation dates are joined to hits here, ids only, rather than to the texts beforehand. ``settings``
    are those of the queries, or None where the hits have them.
    """
    aged = F.when(
        F.col("sort") == "score-recency", recency_divisor(as_of, F.col("creation_date"))
    ).otherwise(1.0)
    dated = add_weight(hits, index_config).join(dates.select("entry_id", "creation_date"), "entry_id")
    dated = dated if settings is None else dated.join(settings, "qid")
    return dated.withColumn("score", F.col(base) * F.col("weight") / aged)


def sort_keys(rank_value: Column) -> list[Column]:
    """Order by the query's own sort and direction, ties by entry id.

    Any sort other than ``date`` and ``id`` is by score.
    """
    sign = F.when(F.col("direction") == "asc", 1).otherwise(-1)
    whole = F.when(F.col("sort") == "date", F.unix_micros("creation_date")).when(
        F.col("sort") == "id", F.col("entry_id")
    )
    score = F.when(F.col("sort").isin("date", "id"), F.lit(0.0)).otherwise(rank_value)
    return [sign * whole, sign * score, F.col("entry_id")]


def paginate(scored: DataFrame, rank_value: Column, deepest: int) -> DataFrame:
    """The rows of each query's page, with their ``rank`` over all its hits.

    Every query is first cut down in as many slots as the cluster shuffles into, so that a
    query matching a large part of all entries is never sorted in one task. Slots go by Spark's own
    hash: hits that lie by entry have each slot in one task, so that few are left to be moved. ``deepest`` is a
    rank that no page exceeds: hits beyond it are cut before they are shuffled. The last step
    sees at most slots times ``deepest`` rows of a query.
    """
    first = F.greatest(F.lit(0), (F.col("page") - 1) * F.col("per_page"))
    last = first + F.col("per_page")
    slots = shuffle_width(scored.sparkSession)
    order = sort_keys(rank_value)
    by_slot = Window.partitionBy("qid", "slot").orderBy(*order)
    by_query = Window.partitionBy("qid").orderBy(*order)
    return (
        scored.withColumn("slot", F.pmod(F.hash("entry_id"), F.lit(slots)))
        .withColumn("rank", F.row_number().over(by_slot))
        .filter(F.col("rank") <= deepest)
        .filter(F.col("rank") <= last)
        .withColumn("rank", F.row_number().over(by_query))
        .filter((F.col("rank") > first) & (F.col("rank") <= last))
        .drop("slot")
    )


def found_rows(hits: DataFrame, settings: DataFrame) -> DataFrame:
    """Total hits and number of pages of every query (0 where nothing matched)."""
    totals = hits.groupBy("qid").agg(F.count(F.lit(1)).alias("total"))
    total = F.coalesce("total", F.lit(0))
    return settings.join(totals, "qid", "left").select(
        "qid",
        total.cast("long").alias("total"),
        F.ceil(total / F.col("per_page")).cast("long").alias("pages"),
        "page",
        "per_page",
    )


def hydrate(page: DataFrame, entries: DataFrame) -> DataFrame:
    """The page of hits with all content columns of the entries."""
    known = [c for c in entries.columns if c != "entry_id" and c in page.columns]
    return page.join(entries.drop(*known), "entry_id")


def filter_by_hits(rows: DataFrame, hits: DataFrame, key: str = "entry_id") -> DataFrame:
    """Rows of another table whose key is the id of a hit."""
    ids = hits.select(F.col("entry_id").alias(key))
    return rows.join(ids, key, "left_semi")
