"""Views over the given parquet tables: what the search jobs read.

Documents stand for content entries, their ``source`` for the section, the event with the
same id for the creation date; events double as the search log and as the change feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.config import QUERY_SCHEMA, SearchConfig, SectionIndex
from wordloom.session import TEXT_PARTITIONS, local_table

PAGE_SECTION = 100
PAGE_ID_BASE = 1_000_000_000
SECTION_IDS = range(1, 21)
AS_OF = "2024-02-01 00:00:00"
ALL_SECTIONS = ",".join(f"src{i - 1}" for i in SECTION_IDS)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts, as it is read; spread out once where the session asks for it.

    Text work is heavy per row, and a small table in one row group is one task. Only the
    caller knows that it is small, so the setting is the caller's and off by default.
    """
    texts = read(spark, sf_dir, name)
    partitions = spark.conf.get(TEXT_PARTITIONS, None)
    return texts.repartition(int(partitions)) if partitions else texts


def section_of(source):
    return F.substring(source, 4, 10).cast("int") + 1


def load_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    section_id = section_of(F.col("source"))
    return (
        read(spark, sf_dir, "documents")
        .select("source")
        .distinct()
        .select(
            section_id.alias("section_id"),
            F.col("source").alias("handle"),
            F.concat(F.lit("Section "), section_id.cast("string")).alias("name"),
        )
    )


def load_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with their content columns: a plain scan, no join moves the texts."""
    return read_texts(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("entry_id"),
        section_of(F.col("source")).alias("section_id"),
        "lang",
        "text",
        "n_chars",
    )


def load_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("entry_id"), F.col("ts").cast("timestamp").alias("creation_date")
    )


def load_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_contents(spark, sf_dir).join(load_dates(spark, sf_dir), "entry_id")


def load_page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_texts(spark, sf_dir, "pages").select(
        (F.col("page_id") + PAGE_ID_BASE).alias("entry_id"),
        F.lit(PAGE_SECTION).alias("section_id"),
        "url",
        "html",
    )


def load_nested_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("entry_id"),
        F.struct(
            F.col("p_name").alias("name"),
            F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).alias("make"),
            F.array("p_type", "p_brand").alias("tags"),
        ).alias("content"),
    )


def load_search_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a search log."""
    return log_rows(read(spark, sf_dir, "events"))


def log_rows(events: DataFrame) -> DataFrame:
    whole = F.floor("value").cast("int")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("event_type").alias("keywords"),
        F.when(F.col("event_type") == "view", "look")
        .otherwise(F.col("event_type"))
        .alias("keywords_manipulated"),
        F.lit("src0,src1").alias("sections"),
        (1 + whole % 5).alias("page"),
        whole.alias("results"),
        F.col("user_id").cast("string").alias("session_id"),
    )


def change_rows(events: DataFrame) -> DataFrame:
    """Events as a feed of entry changes: the user id names the entry that changed."""
    return events.select(
        F.col("user_id").alias("entry_id"),
        F.col("ts").cast("timestamp").alias("changed_at"),
        F.col("event_id").alias("change_id"),
        F.when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "signup", "create")
        .otherwise("edit")
        .alias("op"),
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("note"),
    )


def load_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage, whole, as a quoted phrase query."""
    return read(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("int").alias("qid"),
        F.concat(F.lit('"'), F.col("text"), F.lit('"')).alias("keywords"),
    )


def load_user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn, whole, as a free-text query."""
    return (
        read(spark, sf_dir, "conversations")
        .filter(F.col("role") == "user")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), F.col("text").alias("keywords"))
    )


def load_marked_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user turns written with search signs.

    A new sentence opens a forbidden phrase; a comma closes it and requires the next word.
    """
    marked = F.replace(
        F.replace("keywords", F.lit(". "), F.lit(' -"')), F.lit(", "), F.lit('" +')
    )
    return load_user_turns(spark, sf_dir).withColumn("keywords", marked)


def load_user_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct word of the user turns as a query of its own (qid is the word)."""
    words = F.explode(F.split(F.lower("keywords"), r"\s+")).alias("qid")
    return (
        load_user_turns(spark, sf_dir)
        .select(words)
        .filter(F.col("qid") != "")
        .distinct()
        .select("qid", F.col("qid").alias("keywords"))
    )


def load_phrase_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn as the replacement of its first word, of the next two, and of three."""
    words = F.split(F.lower("keywords"), " ")
    run = lambda at, size: F.array_join(F.slice(words, at, size), " ")
    listed = F.concat_ws(", ", run(1, 1), run(2, 2), run(2, 3))
    return load_user_turns(spark, sf_dir).select(
        F.concat(F.lit("Turn "), F.col("qid")).alias("word"), F.regexp_replace(listed, r"[.]", "").alias("synonyms")
    )


def load_part_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every brand as a replacement word for the names of its parts: a row for each name."""
    parts = read(spark, sf_dir, "part")
    return parts.select(F.col("p_brand").alias("word"), F.col("p_name").alias("synonyms")).distinct()


# One weighting level after another over the sections.
SECTION_CONFIG = [SectionIndex(i, ("text",), (i - 1) % 5) for i in SECTION_IDS]
# Some sections only index English and French entries, or a list of ids.
FILTERED_CONFIG = [
    SectionIndex(1, ("text",), 2, {"lang": "en, fr", "n_chars": " "}),
    SectionIndex(2, ("text",), 2, {"tags": "en+src1"}),
    SectionIndex(3, ("text",), 2, {"id": "2, 22, 42"}),
    SectionIndex(4, ("text",), 2, {"tags": "de, es"}),
    SectionIndex(5, ("text",), 2, {"lang": r"en\,fr, de"}),
] + [SectionIndex(i, ("text",), 2) for i in SECTION_IDS if i > 5]
# Fields differ between sections.
FIELDS_CONFIG = [
    SectionIndex(i, ("lang", "text") if i <= 10 else ("text", "n_chars"), None) for i in SECTION_IDS
]

# The inline queries are few.
CONFIG = SearchConfig(default_sections=ALL_SECTIONS, method="scan")

SYNONYMS = [
    ("United Kingdom", "uk, great britain, GB"),
    ("the", "teh, hte"),
    ("whan", "when"),
    ("les", "le, la"),
    ("Le Monde", "la"),
    ("der", " die ,, das"),
]

# qid, keywords, sections, sort, direction, page, per_page
QUERIES = [
    (1, "the", "", "score", "desc", 1, 20),
    (2, "the tion", "", "score", "desc", 1, 20),
    (3, "+the -whan", "", "score", "desc", 1, 20),
    (4, "-whan", "", "score", "desc", 1, 20),
    (5, '"of the"', "", "score", "desc", 1, 20),
    (6, '-"of the" tion', "", "score", "desc", 1, 20),
    (7, "teh inter", "", "score", "desc", 1, 20),
    (8, "UK", "", "score", "desc", 1, 20),
    (9, "", "", "score", "desc", 1, 20),
    (10, "ab", "", "score", "desc", 1, 20),
    (11, "THE", "", "score", "desc", 1, 0),
    (12, "ing", "src0,src1", "score", "desc", 1, 20),
    (13, "est", "nosuch", "score", "desc", 1, 20),
    (14, "tion", "", "score", "desc", 2, 5),
    (15, "whan", "", "date", "desc", 1, 20),
    (16, "whan", "", "id", "asc", 1, 20),
    (17, "whan", "", "score", "asc", 1, 20),
    (18, "whan", "", "score-recency", "desc", 1, 20),
    (19, "  ing   the -a ", "src2, nosuch , src3,src2", "score-recency", "desc", 1, 10),
    (20, '"the" or -"the" "of the" +"with"', "", "date", "asc", 1, 7),
    (21, "+the tha* -whan", "", "score", "desc", 1, 20),
    (22, '"by the" when', "", "score-recency", "desc", 1, 20),
]


def load_synonyms(spark: SparkSession) -> DataFrame:
    return local_table(spark, SYNONYMS, "word STRING, synonyms STRING")


def load_queries(spark: SparkSession) -> DataFrame:
    return local_table(spark, QUERIES, QUERY_SCHEMA)
