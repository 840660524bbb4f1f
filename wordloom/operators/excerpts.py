"""Excerpts: the passages of a hit around its highlighted words.

Relational throughout: one row per occurrence with the numbers of its place, running sums to
stop at the wanted length, and an interval merge. What stands around a place is looked at where
the text is read; only numbers go through the windows, and the text is cut once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import text as tx

HIT = ["qid", "entry_id"]
# Placeholders that no text holds while the passages are put together.
PAD, MARK_ON, MARK_OFF = "\u0001", "\u0002", "\u0003"
MIN_HIGHLIGHT = 3


def display_text(data: Column) -> Column:
    """Text on one line without markup, a blank at either end."""
    flat = F.regexp_replace(tx.trimmed(data), "\n", "")
    flat = F.regexp_replace(flat, r"\s{2,}", " ")
    spaced = F.replace(F.replace(flat, F.lit("<"), F.lit(" <")), F.lit(">"), F.lit("> "))
    return F.concat(F.lit(" "), tx.strip_tags(spaced), F.lit(" "))


def highlight_words(highlight: Column) -> Column:
    """Distinct words to mark: cleaned, at least three characters, not starting with OR."""
    joined = F.btrim(F.array_join(highlight, " "), F.lit('"'))
    spaced = F.concat(F.lit(" "), tx.strip_punctuation(joined))
    words = F.regexp_extract_all(spaced, F.lit(r' (?!OR)([^" ]+)'), F.lit(1))
    return F.filter(F.array_distinct(words), lambda w: F.char_length(w) >= MIN_HIGHLIGHT)


def hit_texts(hits: DataFrame, parsed: DataFrame, index: DataFrame) -> DataFrame:
    """``(qid, entry_id, text, words)`` of the hits to excerpt."""
    words = parsed.select("qid", highlight_words(F.col("highlight")).alias("words"))
    return (
        index.select("entry_id", "data")
        .join(hits.select(*HIT), "entry_id")
        .join(words, "qid")
        .select(*HIT, display_text(F.col("data")).alias("text"), "words")
    )


def occurrences(texts: DataFrame, half: int) -> DataFrame:
    """``(qid, entry_id, k, n, p, gap, behind, tail)``: the n-th place p of the k-th word.

    Of the ``half`` characters on either side of a place, ``gap`` is where their first blank
    is, ``behind`` how many there are from the place on, and ``tail`` how far their last blank
    lies from the end; 0 where there is none.
    """
    word = F.concat(F.lit("(?iu)(?="), tx.literal_pattern(F.col("word")), F.lit(")"))
    around = F.concat(
        F.lit(f"(?isu)(?<=(.{{{half}}}))(?="),
        tx.literal_pattern(F.col("word")),
        F.lit(f")(?=(.{{0,{half}}}))"),
    )
    padded = F.concat(F.lit(PAD * half), "text")
    ends = F.zip_with(
        F.regexp_extract_all(padded, around, F.lit(1)),
        F.regexp_extract_all(padded, around, F.lit(2)),
        lambda before, behind: F.struct(
            F.locate(" ", F.concat(before, behind)).alias("gap"),
            F.char_length(behind).alias("behind"),
            F.locate(" ", F.reverse(behind)).alias("tail"),
        ),
    )
    per_word = texts.select(*HIT, "text", F.posexplode("words").alias("k", "word")).select(
        *HIT,
        "k",
        F.transform(F.split("text", word), F.char_length).alias("size"),
        ends.alias("ends"),
    )
    upto = Window.partitionBy(*HIT, "k").orderBy("n").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        per_word.select(*HIT, "k", F.posexplode(F.arrays_zip("size", "ends")).alias("n", "o"))
        .select(*HIT, "k", "n", "o.size", "o.ends.*")
        .withColumn("p", F.sum("size").over(upto))
        .filter(F.col("gap").isNotNull())
        .drop("size")
    )


def excerpt_ranges(texts: DataFrame, length: int = 250) -> DataFrame:
    """``(qid, entry_id, range_from, range_to)``: merged passages, cut at blanks.

    Words take turns, first occurrences first, until the passages reach ``length``; a word
    drops out at its first occurrence without a blank to cut at.
    """
    half = length // 2
    placed = occurrences(texts, half).select(
        *HIT,
        "k",
        "n",
        (F.col("p") - half + F.col("gap") - 1).alias("range_from"),
        (F.col("p") + F.col("behind") - F.col("tail")).alias("range_to"),
        (F.col("tail") > 0).alias("usable"),
    )
    so_far = Window.partitionBy(*HIT, "k").orderBy("n").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*HIT).orderBy("n", "k").rowsBetween(
        Window.unboundedPreceding, -1
    )
    taken = (
        placed.withColumn("usable", F.min("usable").over(so_far))
        .filter("usable")
        .withColumn("used", F.sum(F.col("range_to") - F.col("range_from")).over(earlier))
        .filter(F.coalesce("used", F.lit(0)) < length)
        .groupBy(*HIT, "range_from")
        .agg(F.max_by("range_to", F.struct("n", "k")).alias("range_to"))
    )
    by_start = Window.partitionBy(*HIT).orderBy("range_from")
    reach = F.max("range_to").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("range_from") > reach), 1).otherwise(0)
    island = F.sum("fresh").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    return (
        taken.withColumn("fresh", fresh)
        .withColumn("island", island)
        .groupBy(*HIT, "island")
        .agg(F.min("range_from").alias("range_from"), F.max("range_to").alias("range_to"))
        .select(*HIT, F.col("range_from").cast("int"), F.col("range_to").cast("int"))
    )


def excerpts(texts: DataFrame, length: int = 250) -> DataFrame:
    """``(qid, entry_id, excerpt)`` as HTML, matched words in ``<strong>``."""
    passages = (
        excerpt_ranges(texts, length)
        .groupBy(*HIT)
        .agg(F.sort_array(F.collect_list(F.struct("range_from", "range_to"))).alias("ranges"))
    )
    cut = F.transform(
        "ranges",
        lambda r: F.substring(F.col("text"), r["range_from"] + 1, r["range_to"] - r["range_from"]),
    )
    lead = F.when(F.element_at("ranges", 1)["range_from"] == 0, "").otherwise("...")
    body = F.concat(lead, F.array_join(cut, "..."), F.lit("..."))
    any_word = F.concat(
        F.lit("(?iu)("), F.array_join(F.transform("words", tx.literal_pattern), "|"), F.lit(")")
    )
    marked = F.regexp_replace(body, any_word, F.lit(f"{MARK_ON}$1{MARK_OFF}"))
    marked = tx.trimmed(F.regexp_replace(marked, r"\s{2,}", " "))
    too_long = F.char_length("text") > length
    opening = F.when(too_long, F.concat(F.left("text", F.lit(length)), F.lit("..."))).otherwise(
        F.col("text")
    )
    html = tx.escape_html(F.when(F.col("ranges").isNull(), opening).otherwise(marked))
    for raw, tag in ((MARK_ON, "<strong>"), (MARK_OFF, "</strong>"), ("...", "&#8230;")):
        html = F.replace(html, F.lit(raw), F.lit(tag))
    return texts.join(passages, HIT, "left").select(
        *HIT, F.concat(F.lit("<p>"), html, F.lit("</p>")).alias("excerpt")
    )
