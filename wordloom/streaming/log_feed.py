"""Log groups kept up to date from a live log feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordloom.operators.logs import log_states, merge_states, present_states
from wordloom.operators.spans import DAYS_SCHEMA, NUMBERS_SCHEMA, day_bitmaps, day_values, merge_days, new_numbers
from wordloom.session import stored

# Partitions of the stored groups; a batch rewrites those that it has groups of.
PARTS = 32


def read_or_none(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a stored table, none if it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def fold_log_groups(batch: DataFrame, path: str) -> None:
    """Merge a batch into the stored groups: one row per (keywords, session), however many batches.

    First date and depth merge exactly in any order and any number of times, so late rows need no
    state and a repeated batch changes nothing.
    """
    part = F.pmod(F.xxhash64("keywords", "session_id"), F.lit(PARTS)).cast("int")
    rows = stored(log_states(batch).withColumn("part", part), "batch-groups")
    old = read_or_none(batch.sparkSession, path, rows.schema)
    old = old.join(rows.select("part").distinct(), "part", "left_semi").select(*rows.columns)
    merged = merge_states(rows.unionByName(old).drop("part")).withColumn("part", part)
    # Written aside first, since it is read from the folder that it replaces.
    (
        stored(merged, "merged-groups")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part")
        .parquet(path)
    )


def stream_log_groups(
    logs: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Fold each micro-batch into the stored groups.

    ``trigger`` holds the arguments of Spark's trigger; without it the feed takes what there is and
    ends.
    """
    return (
        logs.writeStream.foreachBatch(lambda batch, _: fold_log_groups(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_log_groups(spark: SparkSession, path: str) -> DataFrame:
    return present_states(spark.read.parquet(path).drop("part"))


def fold_log_days(batch: DataFrame, path: str) -> None:
    """Merge a batch into the stored bitmaps of its days.

    Values are numbered first and keep their numbers; bits are only ever set. So a repeated batch
    changes nothing, also one that was broken off between the two, and late rows need no state.
    """
    spark = batch.sparkSession
    values = stored(day_values(batch), "day-values")
    numbers = read_or_none(spark, f"{path}/numbers", NUMBERS_SCHEMA)
    fresh = stored(new_numbers(values, numbers), "fresh-numbers")
    fresh.write.mode("append").partitionBy("part").parquet(f"{path}/numbers")
    days = day_bitmaps(values, numbers.unionByName(fresh))
    old = read_or_none(spark, f"{path}/days", DAYS_SCHEMA)
    old = old.join(values.select("day").distinct(), "day", "left_semi").select(*days.columns)
    # Written aside first, since it is read from the folder that it replaces.
    (
        stored(merge_days(days.unionByName(old)), "merged-days")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(f"{path}/days")
    )


def stream_log_days(
    logs: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Fold each micro-batch into the days; ``trigger`` as for groups."""
    return (
        logs.writeStream.foreachBatch(lambda batch, _: fold_log_days(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_log_days(spark: SparkSession, path: str) -> DataFrame:
    return read_or_none(spark, f"{path}/days", DAYS_SCHEMA)
