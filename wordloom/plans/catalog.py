"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.config import SearchConfig
from wordloom.functions import text as tx
from wordloom.functions.scoring import recency_divisor
from wordloom.functions.stem import stem_vocabulary
from wordloom.operators import (
    completions,
    excerpts,
    indexing,
    logs,
    maintenance,
    matching,
    querytext,
    ranking,
    reports,
    spans,
    suggest,
    topk,
)
from wordloom.plans import search as plans
from wordloom.session import joinable, local_table, shared_folder, stored
from wordloom.sources import index_tables
from wordloom.sources import logs as log_files
from wordloom.sources import tables as src
from wordloom.streaming import index_feed, log_feed

CFG = src.CONFIG
# For batches of any number of words.
BATCH = replace(CFG, method="tokens")
QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def as_of() -> Column:
    return F.lit(src.AS_OF).cast("timestamp")


def stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def doc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexing.build_doc_index(src.load_contents(spark, sf_dir), src.SECTION_CONFIG)


def posting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexing.build_postings(doc_rows(spark, sf_dir), CFG)


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexing.dictionary_of(doc_rows(spark, sf_dir), CFG)


def search_tables(spark: SparkSession, sf_dir: str, cfg: SearchConfig = CFG) -> plans.Tables:
    index = doc_rows(spark, sf_dir)
    postings = None
    if cfg.mode == "fulltext":
        # Both are read from the cleaned texts, which are dear to make.
        texts = stored(indexing.cleaned(index), "cleaned")
        postings = stored(indexing.postings_of(texts, cfg), "postings")
    return plans.Tables(
        doc_index=index,
        entries=src.load_dates(spark, sf_dir),
        sections=stored(src.load_sections(spark, sf_dir), "sections"),
        index_config=indexing.config_frame(spark, src.SECTION_CONFIG),
        synonyms=src.load_synonyms(spark),
        postings=postings,
        dictionary=indexing.build_dictionary(postings) if postings is not None else None,
        positions=stored(indexing.positions_of(texts), "positions") if postings is not None else None,
    )


def prepared(spark: SparkSession, sf_dir: str, cfg: SearchConfig = CFG):
    tables = search_tables(spark, sf_dir, cfg)
    return plans.prepare(src.load_queries(spark), tables, cfg), tables


def matched(spark: SparkSession, sf_dir: str, cfg: SearchConfig = CFG) -> DataFrame:
    ready, tables = prepared(spark, sf_dir, cfg)
    return matching.match_terms(tables.doc_index, ready.terms, ready.resolved, cfg, cfg.mode)


def scored(spark: SparkSession, sf_dir: str, cfg: SearchConfig = CFG) -> DataFrame:
    ready, tables = prepared(spark, sf_dir, cfg)
    return plans.scored_hits(ready, tables, cfg, as_of())


def turn_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keywords of the user turns, cleaned like the index."""
    text = tx.clean_text(F.col("keywords"))
    return (
        src.load_user_turns(spark, sf_dir)
        .select(F.explode(F.split(text, " ")).alias("word"))
        .filter(indexing.is_keyword(F.col("word"), CFG))
        .distinct()
    )


def text_words(df: DataFrame, column: str) -> DataFrame:
    words = F.explode(F.split(tx.clean_text(F.col(column)), " ")).alias("word")
    return df.select(words).filter(indexing.is_keyword(F.col("word"), CFG)).distinct()


# Scans, sources, sinks


@query
def load_entries(spark, sf_dir):
    entries = src.load_entries(spark, sf_dir)
    return entries.select("entry_id", "section_id", "lang", "text", "n_chars", stamp("creation_date"))


@query
def doc_index(spark, sf_dir):
    path = shared_folder(spark, "doc-index")
    doc_rows(spark, sf_dir).write.partitionBy("section_id").parquet(path)
    return spark.read.parquet(path).select("entry_id", "section_id", "data", "data_lc")


def log_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready, tables = prepared(spark, sf_dir)
    hits = matching.match_terms(tables.doc_index, ready.terms, ready.resolved, CFG, "like")
    totals = ranking.found_rows(hits, ready.settings)
    last = src.load_search_logs(spark, sf_dir).agg(F.max("id").alias("id")).scalar()
    return log_files.run_rows(ready.parsed, ready.resolved, totals, as_of(), F.lit("s1"), last)


@query
def append_log(spark, sf_dir):
    path = shared_folder(spark, "search-log")
    log_files.append_log(src.load_search_logs(spark, sf_dir), path)
    log_files.append_log(log_runs(spark, sf_dir), path)
    rows = log_files.read_logs(spark, path)
    return rows.select(
        "id", stamp("date"), "keywords", "keywords_manipulated", "sections", "page", "results", "session_id"
    )


@query
def export_logs_csv(spark, sf_dir):
    path = shared_folder(spark, "log-csv")
    log_files.export_logs_csv(logs.log_groups(src.load_search_logs(spark, sf_dir)), path)
    return log_files.read_logs_csv(spark, path)


# Index build


@query
def indexed_sections_only(spark, sf_dir):
    ids = ["entry_id", "section_id"]
    pages = src.load_page_entries(spark, sf_dir).select(*ids)
    entries = src.load_contents(spark, sf_dir).select(*ids).unionByName(pages)
    return indexing.indexed_sections_only(entries, src.SECTION_CONFIG)


@query
def index_filters(spark, sf_dir):
    entries = src.load_contents(spark, sf_dir)
    handle = F.concat(F.lit("src"), (F.col("section_id") - 1).cast("string"))
    entries = entries.withColumn("tags", F.array("lang", handle))
    return indexing.apply_index_filters(entries, src.FILTERED_CONFIG).select("entry_id", "section_id", "lang")


@query
def included_fields(spark, sf_dir):
    entries = src.load_contents(spark, sf_dir)
    return indexing.select_fields(entries, src.FIELDS_CONFIG).select("entry_id", "section_id", "data")


@query
def flatten_text(spark, sf_dir):
    entries = src.load_nested_entries(spark, sf_dir)
    flat = tx.trimmed(tx.flatten_text("content", entries.schema["content"].dataType))
    return entries.select("entry_id", flat.alias("data"))


@query
def strip_tags(spark, sf_dir):
    pages = src.load_page_entries(spark, sf_dir)
    return pages.select("entry_id", tx.strip_tags(F.col("html")).alias("data"))


@query
def decode_numeric_entities(spark, sf_dir):
    encoded = F.col("text")
    for raw, entity in (("e", "&#101;"), ("a", "&#x61;"), ("é", "&#xE9;"), ("ö", "&#246;")):
        encoded = F.replace(encoded, F.lit(raw), F.lit(entity))
    texts = src.read(spark, sf_dir, "documents").select("doc_id", encoded.alias("text"))
    return texts.select("doc_id", tx.decode_entities(F.col("text")).alias("data"))


@query
def repair_utf8(spark, sf_dir):
    as_bytes = F.when(F.col("lang") == "en", F.encode("text", "UTF-8")).otherwise(
        F.encode("text", "ISO-8859-1")
    )
    raw = src.read(spark, sf_dir, "documents").select("doc_id", as_bytes.alias("raw"))
    return raw.select("doc_id", tx.repair_utf8(F.col("raw")).alias("data"))


@query
def strip_punctuation(spark, sf_dir):
    texts = src.read(spark, sf_dir, "documents")
    return texts.select("doc_id", F.trim(tx.strip_punctuation(F.lower("text"))).alias("data"))


@query
def tokenize_unique(spark, sf_dir):
    return indexing.tokenize(doc_rows(spark, sf_dir)).select("entry_id", "token")


@query
def length_gate(spark, sf_dir):
    tokens = indexing.tokenize(doc_rows(spark, sf_dir)).select("entry_id", "token")
    return tokens.filter(indexing.length_gate(F.col("token"), CFG))


@query
def code_token_filter(spark, sf_dir):
    pages = src.load_page_entries(spark, sf_dir)
    marked_up = F.trim(tx.strip_punctuation(F.lower(F.concat_ws(" ", "url", "html"))))
    tokens = pages.select("entry_id", F.explode(F.array_distinct(F.split(marked_up, " "))).alias("token"))
    return tokens.filter(~indexing.is_code_token(F.col("token")))


@query
def keyword_dictionary(spark, sf_dir):
    known = dictionary(spark, sf_dir)
    pages = text_words(src.load_page_entries(spark, sf_dir), "html")
    merged = indexing.merge_keywords(pages.withColumnRenamed("word", "keyword"), known)
    return merged.select("keyword", "soundex", "sound")


@query
def substring_frequency(spark, sf_dir):
    return posting_rows(spark, sf_dir).select("entry_id", "keyword", "frequency")


@query
def postings(spark, sf_dir):
    path = shared_folder(spark, "postings")
    posting_rows(spark, sf_dir).write.partitionBy("section_id").parquet(path)
    rows = spark.read.parquet(path)
    return rows.select("entry_id", "section_id", "keyword", "frequency", "tf")


# Index maintenance


def changed_entries(spark: SparkSession, sf_dir: str, last: DataFrame) -> DataFrame:
    """Content after the changes: the note of the change is added to the text."""
    entries = src.load_contents(spark, sf_dir)
    notes = last.select("entry_id", "note")
    return entries.join(notes, "entry_id").withColumn("text", F.concat_ws(" ", "text", "note"))


@query
def upsert_entries(spark, sf_dir):
    changes = src.change_rows(src.read(spark, sf_dir, "events"))
    last = stored(maintenance.latest_changes(changes), "last-changes")
    content = changed_entries(spark, sf_dir, last)
    after = maintenance.apply_changes(doc_rows(spark, sf_dir), changes, content, src.SECTION_CONFIG)
    return after.select("entry_id", "section_id", "data")


def deleted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries labelled toxic go."""
    toxic = src.read(spark, sf_dir, "labels").filter("toxic = 1")
    return stored(toxic.select(F.col("doc_id").alias("entry_id")).distinct(), "ids")


@query
def delete_entries(spark, sf_dir):
    left = maintenance.delete_entries(posting_rows(spark, sf_dir), deleted_ids(spark, sf_dir))
    return left.groupBy("entry_id", "section_id").agg(
        F.count(F.lit(1)).alias("keywords"), F.sum("frequency").alias("frequency")
    )


@query
def orphan_keywords(spark, sf_dir):
    rows = stored(posting_rows(spark, sf_dir), "postings")
    left = maintenance.delete_entries(rows, deleted_ids(spark, sf_dir))
    return maintenance.drop_orphans(indexing.build_dictionary(rows), left).select("keyword")


@query
def delete_section(spark, sf_dir):
    return maintenance.delete_section(doc_rows(spark, sf_dir), 3).select("entry_id", "section_id", "data")


@query
def reindex_sections(spark, sf_dir):
    entries = src.load_contents(spark, sf_dir)
    grown = entries.withColumn("text", F.concat_ws(" ", "text", "lang"))
    after = maintenance.reindex_sections(doc_rows(spark, sf_dir), grown, src.SECTION_CONFIG, [2, 5])
    return after.select("entry_id", "section_id", "data")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream; the table may be one file or a folder of files.

    A pattern, since a stream takes a plain path for a folder only.
    """
    schema = src.read(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


@query
def stream_index_changes(spark, sf_dir):
    index = index_tables.IndexTables(spark, shared_folder(spark, "index"), CFG)
    index.build(doc_rows(spark, sf_dir))
    feed = index_feed.stream_index(
        src.change_rows(event_stream(spark, sf_dir)),
        index,
        lambda last: changed_entries(spark, sf_dir, last),
        src.SECTION_CONFIG,
        shared_folder(spark, "index-feed"),
    )
    feed.awaitTermination()
    return index.table("doc_index").select("entry_id", "section_id", "data")


# Query text


@query
def synonym_table(spark, sf_dir):
    return querytext.explode_synonyms(src.load_part_synonyms(spark, sf_dir)).orderBy("word", "term")


@query
def synonym_upsert(spark, sf_dir):
    """Rename every brand that sells ECONOMY parts, drop the brands of the largest parts."""
    parts = src.read(spark, sf_dir, "part")
    economy = parts.filter("p_type = 'ECONOMY'").select(F.col("p_brand").alias("old_word")).distinct()
    edits = economy.select(
        "old_word",
        F.concat(F.lit("New "), "old_word").alias("word"),
        F.lower("old_word").alias("synonyms"),
    )
    deletes = parts.filter("p_size = 50").select(F.col("p_brand").alias("word")).distinct()
    return querytext.merge_synonyms(src.load_part_synonyms(spark, sf_dir), edits, deletes)


@query
def apply_synonyms(spark, sf_dir):
    turns = src.load_marked_turns(spark, sf_dir)
    return querytext.apply_synonyms(turns, src.load_synonyms(spark)).select("qid", "adjusted")


@query
def apply_synonym_phrases(spark, sf_dir):
    """Synonyms of one to three words, taken from the turns, in all marked turns."""
    turns = src.load_marked_turns(spark, sf_dir)
    synonyms = src.load_phrase_synonyms(spark, sf_dir)
    return querytext.apply_synonyms(turns, synonyms, phrases=True).select("qid", "adjusted")


@query
def classify_keywords(spark, sf_dir):
    turns = src.load_marked_turns(spark, sf_dir)
    return querytext.keyword_classes(querytext.classify(turns, CFG, "keywords"))


@query
def require_all_and_wildcard(spark, sf_dir):
    turns = src.load_marked_turns(spark, sf_dir)
    return querytext.expand_boolean(turns, True, True).select("qid", "expanded")


@query
def stem_words(spark, sf_dir):
    words = src.load_user_words(spark, sf_dir).select(F.col("qid").alias("keyword"))
    return stem_vocabulary(words).select("keyword", "stem")


@query
def stem_dictionary(spark, sf_dir):
    return stem_vocabulary(dictionary(spark, sf_dir)).select("keyword", "stem")


QUERIES["stem_vocabulary"] = QUERIES.pop("stem_dictionary")


# Match, score, sort, page


@query
def resolve_sections(spark, sf_dir):
    sections = src.load_sections(spark, sf_dir)
    resolved = querytext.resolve_sections(src.load_queries(spark), sections, CFG)
    errors = querytext.section_errors(src.load_queries(spark), resolved)
    return resolved.select("qid", "section_id", "handle", "name", F.lit(None).cast("string").alias("error")).unionByName(
        errors.select("qid", "error"), allowMissingColumns=True
    )


@query
def index_entry_join(spark, sf_dir):
    joined = matching.join_entries(doc_rows(spark, sf_dir), src.load_dates(spark, sf_dir))
    return joined.select("entry_id", "section_id", stamp("creation_date"), "data")


@query
def section_filter(spark, sf_dir):
    ready, tables = prepared(spark, sf_dir)
    few = ready.resolved.join(src.load_queries(spark).filter("sections != ''"), "qid", "left_semi")
    return matching.in_sections(tables.doc_index, few).select("entry_id", "section_id")


@query
def match_like(spark, sf_dir):
    return matched(spark, sf_dir).select("qid", "entry_id")


@query
def match_like_batch(spark, sf_dir):
    """One query per word of the user turns: matched through the vocabulary."""
    tables = search_tables(spark, sf_dir)
    words = src.load_user_words(spark, sf_dir).withColumn("sections", F.lit(""))
    parsed = stored(querytext.classify(words, CFG, "keywords"), "queries")
    resolved = stored(querytext.resolve_sections(words, tables.sections, CFG), "query-sections")
    tokens = stored(indexing.build_token_index(tables.doc_index), "tokens")
    pieces = stored(matching.build_pieces(tokens), "pieces")
    hits = matching.match_terms(
        tables.doc_index, querytext.query_terms(parsed), resolved, BATCH, "like", tokens, pieces
    )
    return hits.groupBy("qid").agg(
        F.count(F.lit(1)).alias("hits"), F.sum("occurrences").cast("long").alias("occurrences")
    )


@query
def match_like_folded(spark, sf_dir):
    """The words of the user turns, matched without regard to accents."""
    tables = search_tables(spark, sf_dir)
    words = src.load_user_words(spark, sf_dir).withColumn("sections", F.lit(""))
    parsed = stored(querytext.classify(words, CFG, "keywords"), "queries")
    resolved = stored(querytext.resolve_sections(words, tables.sections, CFG), "query-sections")
    cfg = replace(BATCH, fold_accents=True)
    hits = matching.match_terms(tables.doc_index, querytext.query_terms(parsed), resolved, cfg, "like")
    return hits.groupBy("qid").agg(
        F.count(F.lit(1)).alias("hits"), F.sum("occurrences").cast("long").alias("occurrences")
    )


@query
def match_phrases(spark, sf_dir):
    """Every benchmark passage as a quoted phrase."""
    tables = search_tables(spark, sf_dir)
    phrases = src.load_phrases(spark, sf_dir).withColumn("sections", F.lit(""))
    parsed = stored(querytext.classify(phrases, CFG, "keywords"), "queries")
    resolved = stored(querytext.resolve_sections(phrases, tables.sections, CFG), "query-sections")
    hits = matching.match_terms(
        tables.doc_index, querytext.query_terms(parsed), resolved, BATCH, "like"
    )
    return hits.select("qid", "entry_id")


REGEXP = SearchConfig(default_sections=src.ALL_SECTIONS, mode="regexp", method="scan")
FULLTEXT = SearchConfig(default_sections=src.ALL_SECTIONS, mode="fulltext")
STEMMED = SearchConfig(default_sections=src.ALL_SECTIONS, match_stems=True, method="scan")


@query
def match_regexp(spark, sf_dir):
    return matched(spark, sf_dir, REGEXP).select("qid", "entry_id")


@query
def match_fulltext(spark, sf_dir):
    ready, tables = prepared(spark, sf_dir, FULLTEXT)
    terms = matching.boolean_terms(ready.parsed, FULLTEXT)
    hits = matching.match_fulltext(
        tables.postings, tables.dictionary, tables.positions, terms, ready.resolved
    )
    return hits.select("qid", "entry_id")


@query
def match_stemmed(spark, sf_dir):
    tables = search_tables(spark, sf_dir, STEMMED)
    words = src.load_queries(spark)
    endings = F.explode(F.array(F.lit(""), F.lit("ed"), F.lit("ing"), F.lit("s")))
    queries = (
        words.withColumn("ending", endings)
        .withColumn("qid", F.concat_ws("-", "qid", "ending"))
        .withColumn("keywords", F.concat("keywords", "ending"))
    )
    ready = plans.prepare(queries, tables, STEMMED)
    hits = matching.match_terms(tables.doc_index, ready.terms, ready.resolved, STEMMED)
    return hits.select(
        "qid", "entry_id", "keywords_matched", F.col("occurrences").cast("long").alias("occurrences")
    )


@query
def empty_query(spark, sf_dir):
    """Queries that match nothing in a search."""
    found = matched(spark, sf_dir).select("qid").distinct()
    return src.load_queries(spark).select("qid").join(found, "qid", "left_anti")


@query
def keywords_matched(spark, sf_dir):
    return matched(spark, sf_dir).select("qid", "entry_id", "keywords_matched")


@query
def occurrence_score(spark, sf_dir):
    return matched(spark, sf_dir).select("qid", "entry_id", "occurrences")


@query
def section_weighting(spark, sf_dir):
    weighted = ranking.add_weight(
        matched(spark, sf_dir), indexing.config_frame(spark, src.SECTION_CONFIG)
    )
    score = (F.col("occurrences") * F.col("weight")).alias("score")
    return weighted.select("qid", "entry_id", "weight", score)


@query
def recency_decay(spark, sf_dir):
    entries = src.load_entries(spark, sf_dir)
    decay = F.round(1 / recency_divisor(as_of(), F.col("creation_date")), 6)
    return entries.select("entry_id", decay.alias("decay"))


def free_text(spark: SparkSession, sf_dir: str):
    """Every user turn, whole, as free text: its terms and sections."""
    turns = src.load_user_turns(spark, sf_dir).withColumn("sections", F.lit(""))
    sections = stored(src.load_sections(spark, sf_dir), "sections")
    resolved = stored(querytext.resolve_sections(turns, sections, FULLTEXT), "query-sections")
    return matching.boolean_terms(turns, FULLTEXT, "keywords"), resolved


@query
def fulltext_relevance(spark, sf_dir):
    """Every user turn, whole, as free text: the relevance of every entry that has a word of it."""
    rows = stored(posting_rows(spark, sf_dir), "postings")
    terms, resolved = free_text(spark, sf_dir)
    scores = matching.fulltext_relevance(rows, indexing.build_dictionary(rows), terms, resolved)
    return scores.select("qid", "entry_id", "relevance")


@query
def fulltext_top(spark, sf_dir):
    """The twenty most relevant entries of every user turn, by the bounds of its words."""
    rows = stored(posting_rows(spark, sf_dir), "postings")
    terms, resolved = free_text(spark, sf_dir)
    impacts = topk.build_impacts(rows, 20)
    best = topk.fulltext_top(impacts, indexing.build_dictionary(rows), terms, resolved, 20)
    return best.select("qid", "rank", "entry_id", "relevance")


def page_rows(spark: SparkSession, sf_dir: str, cfg: SearchConfig = CFG) -> DataFrame:
    page = plans.search(
        src.load_queries(spark), search_tables(spark, sf_dir, cfg), cfg, as_of()
    )
    return page.select(
        "qid",
        "rank",
        "entry_id",
        "section",
        "keywords_matched",
        F.round("score", 6).alias("score"),
        stamp("creation_date"),
    )


@query
def sort_modes(spark, sf_dir):
    return page_rows(spark, sf_dir).select("qid", "rank", "entry_id")


@query
def paginate(spark, sf_dir):
    """Page two of every query, five hits each."""
    hits = scored(spark, sf_dir).withColumn("page", F.lit(2)).withColumn("per_page", F.lit(5))
    return ranking.paginate(hits, plans.rank_value(), 10).select("qid", "rank", "entry_id")


@query
def found_rows(spark, sf_dir):
    settings = ranking.query_settings(src.load_queries(spark), CFG)
    return ranking.found_rows(matched(spark, sf_dir), settings)


@query
def search(spark, sf_dir):
    return page_rows(spark, sf_dir)


@query
def search_regexp(spark, sf_dir):
    return page_rows(spark, sf_dir, REGEXP)


@query
def search_fulltext(spark, sf_dir):
    return page_rows(spark, sf_dir, FULLTEXT).drop("keywords_matched")


def stored_tables(spark: SparkSession, sf_dir: str) -> plans.Tables:
    """The tables of a stored index, after one batch of changes."""
    index = index_tables.IndexTables(spark, shared_folder(spark, "index"), CFG)
    index.build(doc_rows(spark, sf_dir))
    index.delete_entries(deleted_ids(spark, sf_dir), as_of())
    return index.search_tables(
        sections=stored(src.load_sections(spark, sf_dir), "sections"),
        index_config=indexing.config_frame(spark, src.SECTION_CONFIG),
        synonyms=src.load_synonyms(spark),
        entries=src.load_dates(spark, sf_dir),
    )


@query
def search_stored(spark, sf_dir):
    """The inline queries over a stored index from which the toxic entries were deleted."""
    page = plans.search(src.load_queries(spark), stored_tables(spark, sf_dir), CFG, as_of())
    return page.select("qid", "rank", "entry_id", "section", F.round("score", 6).alias("score"))


@query
def search_batch(spark, sf_dir):
    """Every word of the user turns as a query: scored, and its first five hits."""
    tables = search_tables(spark, sf_dir)
    words = src.load_user_words(spark, sf_dir).select(
        "qid",
        F.col("keywords"),
        F.lit("").alias("sections"),
        F.lit("score").alias("sort"),
        F.lit("desc").alias("direction"),
        F.lit(1).alias("page"),
        F.lit(5).alias("per_page"),
    )
    page = plans.search(words, replace(tables, synonyms=tables.synonyms.limit(0)), BATCH, as_of())
    return page.select("qid", "rank", "entry_id", F.round("score", 6).alias("score"))


@query
def search_run(spark, sf_dir):
    """Pages, totals, alternatives and log rows of the inline queries, from one run."""
    tables = search_tables(spark, sf_dir)
    tables = replace(tables, dictionary=dictionary(spark, sf_dir))
    last = src.load_search_logs(spark, sf_dir).agg(F.max("id").alias("id")).scalar()
    run = plans.search_run(src.load_queries(spark), tables, CFG, as_of(), F.lit("s1"), last)
    per_query = run.page.groupBy("qid").agg(F.count("*").alias("shown"), F.min_by("entry_id", "rank").alias("first"))
    texts = run.excerpts.groupBy("qid").agg(F.count("*").alias("excerpts"))
    other = run.alternatives.groupBy("qid").agg(F.min_by("alternative", F.struct("distance", "word")).alias("alternative"))
    logged = run.log.select(F.col("id").alias("log_id"), (F.col("id") - last).alias("qid"))
    return (
        run.totals.select("qid", "total")
        .join(per_query, "qid", "left")
        .join(texts, "qid", "left")
        .join(other, "qid", "left")
        .join(logged, "qid", "left")
    )


@query
def hydrate_entries(spark, sf_dir):
    page = plans.search(src.load_queries(spark), search_tables(spark, sf_dir), CFG, as_of())
    page = stored(page.select("qid", "rank", "entry_id"), "page")
    hydrated = ranking.hydrate(page, src.load_contents(spark, sf_dir))
    return hydrated.select("qid", "rank", "entry_id", "lang", "n_chars", "text")


@query
def filter_by_hits(spark, sf_dir):
    labels = src.read(spark, sf_dir, "labels")
    return ranking.filter_by_hits(labels, matched(spark, sf_dir, REGEXP), "doc_id")


@query
def filter_section(spark, sf_dir):
    """Every query as a filter on one section of which only labelled entries are indexed."""
    tables = search_tables(spark, sf_dir)
    half = tables.doc_index.join(
        src.read(spark, sf_dir, "labels").select(F.col("doc_id").alias("entry_id")), "entry_id", "left_semi"
    )
    only = src.load_queries(spark).withColumn("sections", F.lit("src2"))
    tables = replace(tables, doc_index=half)
    return plans.filter_section(only, src.load_entries(spark, sf_dir), tables, CFG)


def excerpt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = search_tables(spark, sf_dir)
    queries = src.load_queries(spark)
    ready = plans.prepare(queries, tables, CFG)
    page = plans.ranked_page(ready, plans.scored_hits(ready, tables, CFG, as_of()))
    return plans.page_texts(page, ready, tables, CFG)


@query
def excerpt_ranges(spark, sf_dir):
    return excerpts.excerpt_ranges(excerpt_texts(spark, sf_dir), CFG.excerpt_length)


@query
def excerpt_html(spark, sf_dir):
    return excerpts.excerpts(excerpt_texts(spark, sf_dir), CFG.excerpt_length)


QUERIES["excerpts"] = QUERIES.pop("excerpt_html")


# Did-you-mean and auto-suggest


@query
def soundalikes(spark, sf_dir):
    """Every soundalike of every benchmark word, by the code of full length."""
    words = text_words(src.read(spark, sf_dir, "benchmark"), "text")
    return suggest.soundalikes(words, dictionary(spark, sf_dir))


@query
def soundalikes_short(spark, sf_dir):
    """How many keywords share a benchmark word's four-character code, and the nearest distance."""
    words = text_words(src.read(spark, sf_dir, "benchmark"), "text")
    alike = suggest.soundalikes(words, dictionary(spark, sf_dir), "soundex")
    return alike.groupBy("word").agg(F.count(F.lit(1)).alias("alternatives"), F.min("distance").alias("distance"))


@query
def closest_alternative(spark, sf_dir):
    return suggest.closest_alternative(turn_words(spark, sf_dir), dictionary(spark, sf_dir))


def typed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the user turns as typed text; those before "m" look at two sections."""
    words = src.load_user_words(spark, sf_dir)
    return words.withColumn("sections", F.when(F.col("qid") < "m", "src0, src1").otherwise("nosuch"))


def suggested(spark: SparkSession, sf_dir: str, words: DataFrame) -> DataFrame:
    totals = stored(indexing.keyword_totals(posting_rows(spark, sf_dir)), "keyword-totals")
    words = stored(words, "typed")
    found = suggest.suggest_prefix(joinable(words, "shuffle_hash"), totals.select("keyword").distinct())
    resolved = querytext.resolve_sections(words, src.load_sections(spark, sf_dir), SearchConfig())
    return suggest.suggest_frequency(found, totals, resolved)


@query
def suggest_prefix(spark, sf_dir):
    return suggest.suggest_prefix(typed_words(spark, sf_dir), dictionary(spark, sf_dir))


@query
def suggest_frequency(spark, sf_dir):
    return suggested(spark, sf_dir, typed_words(spark, sf_dir))


@query
def suggest_topk(spark, sf_dir):
    counted = suggested(spark, sf_dir, typed_words(spark, sf_dir))
    return suggest.suggest_topk(counted, CFG, "frequency").drop("handle")


@query
def suggest_stored(spark, sf_dir):
    """The most frequent suggestions, and the first ones by letters, from stored completion lists."""
    totals = stored(indexing.keyword_totals(posting_rows(spark, sf_dir)), "keyword-totals")
    lists = stored(completions.build_completions(totals, CFG.suggest_limit), "completions")
    words = typed_words(spark, sf_dir)
    resolved = querytext.resolve_sections(words, src.load_sections(spark, sf_dir), SearchConfig())
    found = [
        completions.complete(words, lists, totals, resolved, CFG, sort).withColumn("sort", F.lit(sort))
        for sort in completions.SORTS
    ]
    return found[0].unionByName(found[1]).drop("handle")


@query
def keyword_handle(spark, sf_dir):
    counted = suggested(spark, sf_dir, typed_words(spark, sf_dir))
    return suggest.suggest_topk(counted, CFG).select("qid", "rank", "keyword", "handle")


# Search-log analytics


@query
def log_groups(spark, sf_dir):
    groups = logs.log_groups(src.load_search_logs(spark, sf_dir))
    return groups.withColumn("date", stamp("date"))


@query
def log_filter(spark, sf_dir):
    rows = logs.filter_logs(src.load_search_logs(spark, sf_dir), "LI")
    return rows.select("id", "keywords", "session_id")


@query
def log_page(spark, sf_dir):
    groups = logs.log_groups(src.load_search_logs(spark, sf_dir))
    return logs.log_page(groups, "results", "asc", 3, 20).withColumn("date", stamp("date"))


@query
def log_count(spark, sf_dir):
    return logs.log_count(logs.log_groups(src.load_search_logs(spark, sf_dir)), 20)


@query
def unique_users(spark, sf_dir):
    return logs.unique_users(src.load_search_logs(spark, sf_dir))


@query
def unique_searches(spark, sf_dir):
    return logs.unique_searches(src.load_search_logs(spark, sf_dir))


@query
def unique_terms(spark, sf_dir):
    return logs.unique_terms(src.load_search_logs(spark, sf_dir))


@query
def average_results(spark, sf_dir):
    return logs.average_results(logs.log_groups(src.load_search_logs(spark, sf_dir)))


@query
def log_stats(spark, sf_dir):
    return logs.log_stats(logs.log_groups(src.load_search_logs(spark, sf_dir)))


@query
def adjusted_keywords(spark, sf_dir):
    groups = logs.log_groups(src.load_search_logs(spark, sf_dir))
    return logs.show_adjusted(groups).select("keywords", "session_id", "adjusted")


@query
def recent_searches(spark, sf_dir):
    groups = logs.log_groups(src.load_search_logs(spark, sf_dir))
    return logs.recent_searches(groups, 20).withColumn("date", stamp("date"))


@query
def already_logged(spark, sf_dir):
    """The searches of the last ten days against the log before them."""
    rows = src.load_search_logs(spark, sf_dir)
    start = F.lit("2024-01-21").cast("timestamp")
    new = rows.filter(F.col("date") >= start).select("id", "keywords", "sections", "session_id")
    return logs.flag_seen(new, rows.filter(F.col("date") < start)).select("id", "already_logged")


@query
def stream_log_groups(spark, sf_dir):
    path = shared_folder(spark, "log-groups")
    feed = log_feed.stream_log_groups(
        src.log_rows(event_stream(spark, sf_dir)), path, shared_folder(spark, "log-feed")
    )
    feed.awaitTermination()
    return log_feed.stored_log_groups(spark, path).withColumn("date", stamp("date"))


@query
def unique_by_span(spark, sf_dir):
    """Users, searches and terms of the seven days up to each day, from the days that a feed has stored."""
    path = shared_folder(spark, "log-days")
    feed = log_feed.stream_log_days(
        src.log_rows(event_stream(spark, sf_dir)), path, shared_folder(spark, "days-feed")
    )
    feed.awaitTermination()
    days = log_feed.stored_log_days(spark, path)
    last = days.select(F.col("day").alias("last_day")).distinct()
    counts = spans.count_spans(last.withColumn("first_day", F.date_sub("last_day", 6)), days)
    return counts.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query
def log_stats_filtered(spark, sf_dir):
    """The four statistics under one keyword filter."""
    rows = logs.filter_logs(src.load_search_logs(spark, sf_dir), "LI")
    return logs.log_stats(logs.log_groups(rows))


# Index reports


@query
def index_size(spark, sf_dir):
    sections = src.load_sections(spark, sf_dir)
    config = [c for c in src.SECTION_CONFIG if c.section_id != 20]
    index = indexing.build_doc_index(src.load_contents(spark, sf_dir).filter("section_id != 19"), config)
    return reports.index_size(sections, indexing.config_frame(spark, config), index)


@query
def index_summary(spark, sf_dir):
    config = [c for c in src.FIELDS_CONFIG if c.section_id != 20]
    labels = local_table(
        spark,
        [("text", "Text", 1), ("lang", "Language", 2), ("n_chars", "Length", 3)],
        "element_name STRING, label STRING, position INT",
    )
    sections = src.load_sections(spark, sf_dir)
    return reports.index_summary(sections, indexing.config_frame(spark, config), labels)
