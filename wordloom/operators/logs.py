"""Search-log analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.config import DIRECTIONS, check_choice

LOG_SORTS = ("date", "keywords", "results", "depth")
CARRIED = ("keywords_manipulated", "sections", "results")


def log_states(logs: DataFrame) -> DataFrame:
    """One mergeable row per (keywords, session): its first search and its deepest page."""
    first = F.min(F.struct("date", "id", *CARRIED)).alias("first")
    return logs.groupBy("keywords", "session_id").agg(first, F.max("page").alias("depth"))


def merge_states(states: DataFrame) -> DataFrame:
    return states.groupBy("keywords", "session_id").agg(
        F.min("first").alias("first"), F.max("depth").alias("depth")
    )


def present_states(states: DataFrame) -> DataFrame:
    return states.select(
        "keywords", "session_id", "first.date", *[f"first.{c}" for c in CARRIED], "depth"
    )


def log_groups(logs: DataFrame) -> DataFrame:
    """A session's searches for the same keywords as one row: first date, depth."""
    return present_states(log_states(logs))


def filter_logs(logs: DataFrame, text: str | None) -> DataFrame:
    """Logs whose keywords contain the text, in any case; no text keeps all."""
    if not text:
        return logs
    return logs.filter(F.contains(F.lower("keywords"), F.lit(text.lower())))


def log_page(
    groups: DataFrame, sort: str = "date", direction: str = "desc", page: int | None = 1, size: int = 20
) -> DataFrame:
    """One page of groups in the chosen order; ``page=None`` gives all of them."""
    check_choice("sort", sort, LOG_SORTS)
    check_choice("direction", direction, DIRECTIONS)
    key = F.col(sort).asc() if direction == "asc" else F.col(sort).desc()
    ordered = groups.orderBy(key, "keywords", "session_id")
    if page is None:
        return ordered
    return ordered.offset(max(0, (page - 1) * size)).limit(size)


def log_count(groups: DataFrame, size: int = 20) -> DataFrame:
    total = F.count(F.lit(1))
    return groups.agg(total.alias("total"), F.ceil(total / size).cast("long").alias("pages"))


def unique_users(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count_distinct("session_id").alias("unique_users"))


def unique_searches(logs: DataFrame) -> DataFrame:
    groups = logs.select("keywords", "session_id").distinct()
    return groups.agg(F.count(F.lit(1)).alias("unique_searches"))


def unique_terms(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count_distinct("keywords").alias("unique_terms"))


def average_results(groups: DataFrame) -> DataFrame:
    """Mean results over the groups, cut to a whole number."""
    return groups.agg(F.avg("results").cast("int").alias("average_results"))


def log_stats(groups: DataFrame) -> DataFrame:
    """The four log statistics from one pass over the groups."""
    return groups.agg(
        F.count_distinct("session_id").alias("unique_users"),
        F.count(F.lit(1)).alias("unique_searches"),
        F.count_distinct("keywords").alias("unique_terms"),
        F.avg("results").cast("int").alias("average_results"),
    )


def show_adjusted(groups: DataFrame) -> DataFrame:
    """Adjusted keywords only where they differ from the typed ones."""
    typed = F.lower(F.trim("keywords"))
    adjusted = F.lower(F.trim("keywords_manipulated"))
    differs = (F.col("keywords_manipulated") != "") & (typed != adjusted)
    return groups.withColumn("adjusted", F.when(differs, F.col("keywords_manipulated")))


def recent_searches(groups: DataFrame, size: int = 20) -> DataFrame:
    return log_page(groups, "date", "desc", 1, size).select("date", "keywords", "results")


def flag_seen(new: DataFrame, logs: DataFrame) -> DataFrame:
    """Mark searches whose keywords, sections and session are in the log already."""
    keys = ["keywords", "sections", "session_id"]
    seen = logs.select(*keys).distinct().withColumn("already_logged", F.lit(True))
    return new.join(seen, keys, "left").withColumn(
        "already_logged", F.coalesce("already_logged", F.lit(False))
    )
