"""Reports on the index itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.scoring import weight_label


def index_size(sections: DataFrame, index_config: DataFrame, index: DataFrame) -> DataFrame:
    """Indexed entries per section; no number where a section is not configured."""
    counts = index.groupBy("section_id").agg(F.count(F.lit(1)).alias("entries"))
    configured = index_config.select("section_id", F.lit(True).alias("configured"))
    return (
        sections.join(configured, "section_id", "left")
        .join(counts, "section_id", "left")
        .select(
            "section_id",
            "name",
            F.when(F.col("configured"), F.coalesce("entries", F.lit(0))).alias("entries"),
        )
    )


def index_summary(sections: DataFrame, index_config: DataFrame, labels: DataFrame) -> DataFrame:
    """Field labels and weighting label per section; none where not configured.

    ``labels`` gives each field's ``(element_name, label, position)``.
    """
    fields = (
        index_config.select("section_id", F.explode("fields").alias("element_name"))
        .join(labels, "element_name")
        .groupBy("section_id")
        .agg(F.sort_array(F.collect_list(F.struct("position", "label"))).alias("items"))
        .select(
            "section_id",
            F.array_join(F.transform("items", lambda i: i["label"]), ", ").alias("fields"),
        )
    )
    settings = index_config.select(
        "section_id", weight_label(F.col("weighting")).alias("weighting")
    )
    return (
        sections.select("section_id", "name")
        .join(fields, "section_id", "left")
        .join(settings, "section_id", "left")
    )
