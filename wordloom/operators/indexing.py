"""Index build: filter entries, flatten and clean their text, count keywords."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.config import POSTINGS_SCHEMA, SearchConfig, SectionIndex
from wordloom.functions import text as tx
from wordloom.functions.counting import counting_of, keyword_test
from wordloom.session import local_table


def config_frame(spark: SparkSession, config: list[SectionIndex]) -> DataFrame:
    """The per-section settings as a table (one row per configured section)."""
    rows = [(c.section_id, list(c.fields), c.weighting, list(c.filters.items())) for c in config]
    return local_table(
        spark,
        rows,
        "section_id INT, fields ARRAY<STRING>, weighting INT, filters MAP<STRING,STRING>",
    )


def indexed_sections_only(entries: DataFrame, config: list[SectionIndex]) -> DataFrame:
    """Entries of configured sections; a literal list, so the scan can prune on it."""
    return entries.filter(F.col("section_id").isin([c.section_id for c in config]))


def parse_filter(spec: str) -> tuple[bool, list[str]]:
    """``(all_required, values)`` of a filter spec."""
    all_required = "+" in spec
    parts = re.split(r"\+\s*" if all_required else r"(?<!\\),\s*", spec)
    return all_required, [p.strip().replace("\\,", ",") for p in parts if p.strip()]


def filter_predicate(schema: T.StructType, filters: dict[str, str]) -> Column:
    predicate = F.lit(True)
    for column, spec in filters.items():
        if not spec or not spec.strip():
            continue
        all_required, values = parse_filter(spec)
        name = "entry_id" if column == "id" else column
        if isinstance(schema[name].dataType, T.ArrayType):
            tests = [F.array_contains(name, v) for v in values]
        else:
            tests = [F.col(name).cast("string") == v for v in values]
        if column == "id":
            predicate &= F.col(name).isin([int(v) for v in values])
        elif all_required:
            for test in tests:
                predicate &= test
        elif isinstance(schema[name].dataType, T.ArrayType):
            any_of = F.lit(False)
            for test in tests:
                any_of |= test
            predicate &= any_of
        else:
            predicate &= F.col(name).isin(values)
    return predicate


def apply_index_filters(entries: DataFrame, config: list[SectionIndex]) -> DataFrame:
    """Entries of configured sections that pass their section's filters.

    Sections with equal filters share one predicate, so the condition stays small and
    simple enough to reach the scan.
    """
    groups: dict[tuple, list[int]] = {}
    for section in config:
        groups.setdefault(tuple(sorted(section.filters.items())), []).append(section.section_id)
    keep = F.lit(False)
    for filters, ids in groups.items():
        keep |= F.col("section_id").isin(ids) & filter_predicate(entries.schema, dict(filters))
    return entries.filter(keep)


def select_fields(entries: DataFrame, config: list[SectionIndex], out: str = "data") -> DataFrame:
    """The text of each section's configured fields, in field order, as one column."""
    groups: dict[tuple, list[int]] = {}
    for section in config:
        groups.setdefault(tuple(section.fields), []).append(section.section_id)
    value = F.lit(None).cast("string")
    for fields, ids in groups.items():
        parts = [tx.flatten_text(f, entries.schema[f].dataType) for f in fields]
        joined = F.concat(*parts) if parts else F.lit("")
        value = F.when(F.col("section_id").isin(ids), joined).otherwise(value)
    return entries.withColumn(out, tx.trimmed(value))


def build_doc_index(entries: DataFrame, config: list[SectionIndex]) -> DataFrame:
    """One row per indexed entry: its text, and the lower-cased text searches run on."""
    kept = apply_index_filters(entries, config)
    return select_fields(kept, config).select(
        "entry_id", "section_id", "data", F.lower("data").alias("data_lc")
    )


def cleaned(doc_index: DataFrame) -> DataFrame:
    return doc_index.select(
        "entry_id",
        "section_id",
        tx.clean_text(F.col("data")).alias("text"),
    )


def length_gate(word: Column, cfg: SearchConfig) -> Column:
    return (F.octet_length(word) < cfg.max_word_length) & (
        F.char_length(word) >= cfg.min_word_length
    )


def is_code_token(word: Column) -> Column:
    """Whether a token looks like markup, code or a path."""
    found = F.lit(False)
    for start in tx.CODE_STARTS:
        found |= F.startswith(word, F.lit(start))
    for end in tx.CODE_ENDS:
        found |= F.endswith(word, F.lit(end))
    for part in tx.CODE_PARTS:
        found |= F.contains(word, F.lit(part))
    return found


def is_keyword(word: Column, cfg: SearchConfig) -> Column:
    return length_gate(word, cfg) & ~is_code_token(word)


def tokenize(doc_index: DataFrame) -> DataFrame:
    """Distinct cleaned tokens per entry, before any length or code test."""
    words = F.array_distinct(F.split("text", " "))
    return cleaned(doc_index).select(
        "entry_id", "section_id", F.explode(F.filter(words, lambda w: w != "")).alias("token")
    )


def build_postings(doc_index: DataFrame, cfg: SearchConfig) -> DataFrame:
    return postings_of(cleaned(doc_index), cfg)


def postings_of(texts: DataFrame, cfg: SearchConfig) -> DataFrame:
    """(entry, keyword) rows: ``frequency`` counts substrings, ``tf`` whole tokens.

    One narrow pass over the cleaned texts, without any shuffle. Cleaning is built-in expressions; the
    keywords are told from other tokens where they are counted, on Arrow batches, since that reads the
    tokens anyhow and only texts go there.
    """
    keywords_of = keyword_test(
        cfg.min_word_length, cfg.max_word_length, tx.CODE_STARTS, tx.CODE_ENDS, tx.CODE_PARTS
    )
    docs = texts.select("entry_id", "section_id", "text")
    return docs.mapInArrow(counting_of(keywords_of), POSTINGS_SCHEMA)


def with_ids(keywords: DataFrame) -> DataFrame:
    """Dictionary columns: a stable id, and the two codes did-you-mean can go by.

    ``sound`` is the Soundex code of full length, ``soundex`` the one of four characters.
    """
    return keywords.select(
        F.xxhash64("keyword").alias("keyword_id"),
        "keyword",
        F.soundex("keyword").alias("soundex"),
        tx.long_soundex(F.col("keyword")).alias("sound"),
    )


def build_dictionary(postings: DataFrame) -> DataFrame:
    return with_ids(postings.select("keyword").distinct())


def dictionary_of(doc_index: DataFrame, cfg: SearchConfig) -> DataFrame:
    """The dictionary straight from the texts, where no postings are stored."""
    words = tokenize(doc_index).select(F.col("token").alias("keyword")).distinct()
    return with_ids(words.filter(is_keyword(F.col("keyword"), cfg)))


def merge_keywords(tokens: DataFrame, keywords: DataFrame) -> DataFrame:
    """The dictionary with the unseen words of ``tokens`` added."""
    fresh = tokens.select("keyword").distinct().join(keywords, "keyword", "left_anti")
    return keywords.unionByName(with_ids(fresh))


def keyword_totals(postings: DataFrame) -> DataFrame:
    """Per keyword and section: summed frequency and number of entries."""
    return postings.groupBy("keyword", "section_id").agg(
        F.sum("frequency").alias("frequency"), F.count(F.lit(1)).alias("entries")
    )


def build_token_index(doc_index: DataFrame) -> DataFrame:
    """``(entry_id, section_id, token, times)``: the distinct blank-separated pieces of each
    lower-cased text, for matching large query batches.

    Counted inside each row, on its sorted pieces, so nothing is shuffled.
    """
    pieces = F.filter(F.split("data_lc", r"\s+"), lambda w: w != "")
    # An exploded array of one is computed once, whatever reads it.
    rows = doc_index.select(
        "entry_id", "section_id", F.explode(F.array(F.sort_array(pieces))).alias("pieces")
    )
    first = F.filter(
        F.transform("pieces", lambda w, i: F.struct(w.alias("token"), i.alias("at"))),
        lambda p: (p["at"] == 0) | (p["token"] != F.col("pieces")[F.greatest(p["at"] - 1, F.lit(0))]),
    )
    rows = rows.select(
        "entry_id", "section_id", F.size("pieces").alias("size"), F.explode(F.array(first)).alias("first")
    )
    following = lambda i: F.coalesce(F.get("first", i + 1)["at"], F.col("size"))
    counted = F.transform(
        "first",
        lambda p, i: F.struct(p["token"].alias("token"), (following(i) - p["at"]).alias("times")),
    )
    return rows.select("entry_id", "section_id", F.inline(counted))


def build_positions(doc_index: DataFrame) -> DataFrame:
    return positions_of(cleaned(doc_index))


def positions_of(texts: DataFrame) -> DataFrame:
    """``(entry_id, section_id, token, places)``: where each token stands in the cleaned text.

    Every token has its row, keyword or not, so that phrases of any words can be found. Gathered
    inside each row, on its sorted tokens, so nothing is shuffled.
    """
    words = F.transform(F.split("text", " "), lambda w, i: F.struct(w.alias("token"), i.alias("at")))
    # Cleaned texts have single blanks, so only an empty one has an empty token. An exploded array of
    # one is computed once, whatever reads it.
    rows = texts.filter("text != ''").select(
        "entry_id", "section_id", F.explode(F.array(F.sort_array(words))).alias("words")
    )
    numbers = F.sequence(F.lit(0), F.size("words") - 1)
    starts = F.filter(
        numbers,
        lambda i: (i == 0) | (F.get("words", i)["token"] != F.get("words", F.greatest(i - 1, F.lit(0)))["token"]),
    )
    rows = rows.select("entry_id", "section_id", "words", F.explode(F.array(starts)).alias("starts"))
    end = lambda i: F.coalesce(F.get("starts", i + 1), F.size("words"))
    lists = F.transform(
        "starts",
        lambda s, i: F.struct(
            F.get("words", s)["token"].alias("token"),
            F.transform(F.slice("words", s + 1, end(i) - s), lambda w: w["at"]).alias("places"),
        ),
    )
    return rows.select("entry_id", "section_id", F.inline(lists))
