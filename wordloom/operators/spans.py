"""Exact distinct counts over spans of days, from mergeable bitmaps.

Every session, search (keywords and session) and term gets a number once; a day holds one bitmap per
block of numbers that occur in it. A span of days is an OR of its days' bitmaps, whatever the number
of log rows: no row is read again. Numbers are given within parts of the values' hash, so that new values
are numbered by many tasks, and are dense within a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed layout: numbers of a part begin at part * 2**SHIFT.
SHIFT = 40
PARTS = 16
NUMBERS_SCHEMA = "kind STRING, value STRING, number LONG, part INT"
DAYS_SCHEMA = "kind STRING, block LONG, bits BINARY, day DATE"
# What is counted, and the column of the reports.
KINDS = {"session": "unique_users", "search": "unique_searches", "term": "unique_terms"}


def day_values(logs: DataFrame) -> DataFrame:
    """``(kind, value, day)``, distinct: what each day has to count.

    Null sessions and null keywords are no user and no term, as in a distinct count, but a search
    is one also with nulls. Rows without a date belong to no day.
    """
    search = F.to_json(F.struct("keywords", "session_id"))
    pairs = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
            for kind, value in (("session", F.col("session_id")), ("search", search), ("term", F.col("keywords")))
        ]
    )
    # Sessions and terms repeat within the searches of a day, so these are made distinct first.
    days = logs.select(F.to_date("date").alias("day"), "keywords", "session_id").filter("day IS NOT NULL").distinct()
    return days.select("day", F.inline(pairs)).filter("value IS NOT NULL").distinct()


def part_of(value: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(parts)).cast("int")


def new_numbers(values: DataFrame, numbers: DataFrame, parts: int = PARTS) -> DataFrame:
    """Numbers for the values that have none, after the last one of their kind and part."""
    fresh = values.select("kind", "value").distinct().join(numbers, ["kind", "value"], "left_anti")
    fresh = fresh.withColumn("part", part_of(F.col("value"), parts))
    start = F.shiftleft(F.col("part").cast("long"), SHIFT)
    last = numbers.groupBy("kind", "part").agg(F.max("number").alias("last"))
    place = F.row_number().over(Window.partitionBy("kind", "part").orderBy("value"))
    number = F.coalesce("last", start) + place
    return fresh.join(last, ["kind", "part"], "left").select("kind", "value", number.alias("number"), "part")


def day_bitmaps(values: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(kind, block, bits, day)`` of numbered values."""
    numbered = values.join(numbers.select("kind", "value", "number"), ["kind", "value"])
    block, position = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    return (
        numbered.select("kind", "day", block.alias("block"), position.alias("position"))
        .groupBy("kind", "block", "day")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
        .select("kind", "block", "bits", "day")
    )


def merge_days(days: DataFrame) -> DataFrame:
    """Bitmaps of the same block and day as one."""
    merged = days.groupBy("kind", "block", "day").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.select("kind", "block", "bits", "day")


def count_spans(spans: DataFrame, days: DataFrame) -> DataFrame:
    """``(first_day, last_day, unique_users, unique_searches, unique_terms)`` of each span of days.

    ``spans`` holds ``first_day`` and ``last_day``, both included. A span without any search, also one
    that ends before it begins, counts zero.
    """
    asked = spans.select("first_day", "last_day").distinct()
    each = F.when(F.col("first_day") <= F.col("last_day"), F.sequence("first_day", "last_day"))
    blocks = (
        asked.select("first_day", "last_day", F.explode(each).alias("day"))
        .join(days, "day")
        .groupBy("first_day", "last_day", "kind", "block")
        .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    )
    counts = blocks.groupBy("first_day", "last_day").agg(
        *[F.sum(F.when(F.col("kind") == kind, F.col("n"))).alias(name) for kind, name in KINDS.items()]
    )
    return asked.join(counts, ["first_day", "last_day"], "left").na.fill(0, list(KINDS.values()))
