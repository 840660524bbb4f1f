"""The search log as a table, and its CSV export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.config import LOG_SCHEMA

# Header of the exported log.
CSV_COLUMNS = {
    "Date": "date",
    "Keywords": "keywords",
    "Adjusted Keywords": "keywords_manipulated",
    "Results": "results",
    "Depth": "depth",
    "Session ID": "session_id",
}


def run_rows(
    adjusted: DataFrame,
    resolved: DataFrame,
    totals: DataFrame,
    as_of: Column,
    session: Column,
    after: Column,
) -> DataFrame:
    """One log row per executed search; searches without a valid section are not logged.

    Ids follow ``after``, the last id of the log, by the queries' own (positive) numbers.
    """
    handles = resolved.groupBy("qid").agg(
        F.sort_array(F.collect_list(F.struct("pos", "handle"))).alias("items")
    )
    return (
        adjusted.select("qid", "keywords", "adjusted")
        .join(handles, "qid")
        .join(totals.select("qid", "total", "page"), "qid")
        .select(
            (after + F.col("qid").cast("long")).alias("id"),
            as_of.cast("timestamp").alias("date"),
            F.trim("keywords").alias("keywords"),
            F.col("adjusted").alias("keywords_manipulated"),
            F.array_join(F.transform("items", lambda i: i["handle"]), ",").alias("sections"),
            F.col("page").cast("int").alias("page"),
            F.col("total").cast("int").alias("results"),
            session.alias("session_id"),
        )
    )


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def export_logs_csv(groups: DataFrame, path: str) -> None:
    """All groups as CSV; every executor writes its own part files."""
    stamp = F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date")
    columns = [
        (stamp if c == "date" else F.col(c)).alias(title) for title, c in CSV_COLUMNS.items()
    ]
    groups.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def read_logs_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(
        f"`{title}` {'INT' if title in ('Results', 'Depth') else 'STRING'}" for title in CSV_COLUMNS
    )
    return spark.read.option("header", True).schema(schema).csv(path)
