"""Whole searches, composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.config import SearchConfig, check_choice
from wordloom.operators import matching, ranking
from wordloom.operators.excerpts import excerpts, hit_texts
from wordloom.operators.querytext import (
    apply_synonyms,
    classify,
    expand_boolean,
    highlight_stems,
    query_terms,
    resolve_sections,
    section_errors,
)
from wordloom.operators.suggest import closest_alternative
from wordloom.session import stored
from wordloom.sources.logs import run_rows


@dataclass(frozen=True)
class Tables:
    """What a search reads.

    Of ``entries`` only id and creation date are used. ``postings``, ``dictionary`` and
    ``positions`` are needed in full-text mode, ``tokens`` and ``pieces`` spare large batches the
    splitting of the texts and of their words.
    """

    doc_index: DataFrame
    sections: DataFrame
    index_config: DataFrame
    synonyms: DataFrame
    entries: DataFrame
    postings: DataFrame | None = None
    dictionary: DataFrame | None = None
    tokens: DataFrame | None = None
    positions: DataFrame | None = None
    pieces: DataFrame | None = None


@dataclass(frozen=True)
class Prepared:
    """A query table after synonyms, classification and section lookup."""

    parsed: DataFrame
    terms: DataFrame
    resolved: DataFrame
    settings: DataFrame


def prepare(queries: DataFrame, tables: Tables, cfg: SearchConfig) -> Prepared:
    if cfg.mode == "fulltext" and (cfg.append_all_words_required or cfg.append_wildcard):
        marked = expand_boolean(queries, cfg.append_all_words_required, cfg.append_wildcard)
        queries = marked.withColumn("keywords", F.col("expanded")).drop("expanded")
    parsed = stored(classify(apply_synonyms(queries, tables.synonyms, cfg.synonym_phrases), cfg), "queries")
    return Prepared(
        parsed,
        query_terms(parsed),
        stored(resolve_sections(parsed, tables.sections, cfg), "query-sections"),
        ranking.query_settings(parsed, cfg),
    )


def require_sections(queries: DataFrame, prepared: Prepared) -> None:
    """Raise where a query has no valid section, sort or direction.

    ``section_errors`` and ``ranking.setting_errors`` list the queries.
    """
    for errors in (section_errors(queries, prepared.resolved), ranking.setting_errors(queries)):
        bad = errors.groupBy("error").count().first()
        if bad:
            raise ValueError(f"{bad['error']} in {bad['count']} queries")


def scored_hits(prepared: Prepared, tables: Tables, cfg: SearchConfig, as_of: Column) -> DataFrame:
    """Every hit of every query with ``keywords_matched`` and ``score``."""
    check_choice("mode", cfg.mode, ("like", "regexp", "fulltext"))
    if cfg.mode == "fulltext":
        terms = matching.boolean_terms(prepared.parsed, cfg)
        hits = matching.match_fulltext(
            tables.postings, tables.dictionary, tables.positions, terms, prepared.resolved
        )
        hits = stored(hits, "boolean-hits")
        relevance = matching.fulltext_relevance(
            tables.postings, tables.dictionary, terms, prepared.resolved, hits=hits
        )
        hits = hits.join(relevance.drop("section_id"), ["qid", "entry_id"]).withColumn(
            "keywords_matched", F.lit(1)
        )
        return ranking.add_scores(
            hits, prepared.settings, tables.index_config, tables.entries, as_of, "relevance"
        )
    hits = matching.match_terms(
        tables.doc_index, prepared.terms, prepared.resolved, cfg, cfg.mode, tables.tokens, tables.pieces,
        prepared.settings,
    )
    return ranking.add_scores(hits, None, tables.index_config, tables.entries, as_of)


def rank_value() -> Column:
    return F.col("keywords_matched") * F.col("score")


def search(
    queries: DataFrame, tables: Tables, cfg: SearchConfig, as_of: Column, strict: bool = False
) -> DataFrame:
    """The page of hits of every query, best first, with the section they come from.

    Queries without a valid section give no rows; ``section_errors`` lists them, and
    ``strict`` raises instead.
    """
    prepared = prepare(queries, tables, cfg)
    if strict:
        require_sections(queries, prepared)
    page = ranked_page(prepared, scored_hits(prepared, tables, cfg, as_of))
    return with_handles(page, tables.sections)


def ranked_page(prepared: Prepared, hits: DataFrame) -> DataFrame:
    """The page of every query; the deepest one asked for bounds all of them."""
    return ranking.paginate(hits, rank_value(), ranking.deepest_rank(prepared.settings))


@dataclass(frozen=True)
class SearchRun:
    """All that one run of searches gives, from one pass of matching."""

    page: DataFrame
    totals: DataFrame
    excerpts: DataFrame
    alternatives: DataFrame
    log: DataFrame


def search_run(
    queries: DataFrame,
    tables: Tables,
    cfg: SearchConfig,
    as_of: Column,
    session: Column,
    log_after: Column,
) -> SearchRun:
    """Page, totals, excerpts, spelling alternatives and log rows of a batch of searches.

    Hits are found, scored and stored once; everything else reads them. Alternatives are given
    for the included words of queries without a hit. Log ids follow ``log_after``. Needs
    ``tables.dictionary``.
    """
    prepared = prepare(queries, tables, cfg)
    hits = stored(scored_hits(prepared, tables, cfg, as_of), "hits")
    page = stored(ranked_page(prepared, hits), "pages")
    totals = stored(ranking.found_rows(hits, prepared.settings), "totals")
    missed = totals.filter("total = 0").select("qid")
    words = prepared.parsed.join(missed, "qid", "left_semi").select(
        "qid", F.explode("include_word").alias("word")
    )
    near = closest_alternative(words.select("word").distinct(), tables.dictionary)
    return SearchRun(
        with_handles(page, tables.sections),
        totals,
        page_excerpts(page, prepared, tables, cfg),
        words.join(near, "word").select("qid", "word", "alternative", "distance"),
        run_rows(prepared.parsed, prepared.resolved, totals, as_of, session, log_after),
    )


def with_handles(page: DataFrame, sections: DataFrame) -> DataFrame:
    return page.join(sections.select("section_id", F.col("handle").alias("section")), "section_id")


def page_excerpts(page: DataFrame, prepared: Prepared, tables: Tables, cfg: SearchConfig) -> DataFrame:
    """Excerpts for a page of hits only, never for all hits.

    The page is stored first: of a known size, it is broadcast to the texts. The texts of
    its hits are stored in turn, so that the index is read once.
    """
    return excerpts(page_texts(page, prepared, tables, cfg), cfg.excerpt_length)


def page_texts(page: DataFrame, prepared: Prepared, tables: Tables, cfg: SearchConfig) -> DataFrame:
    page = stored(page.select("qid", "entry_id"), "page")
    parsed = highlight_stems(prepared.parsed) if cfg.stem_words else prepared.parsed
    return stored(hit_texts(page, parsed, tables.doc_index), "page-texts")


def filter_section(
    queries: DataFrame, entries: DataFrame, tables: Tables, cfg: SearchConfig
) -> DataFrame:
    """Keyword filter on one section per query, without ranking: ``(qid, entry_id)``.

    A query without usable keywords keeps all entries of its section; otherwise entries
    that are not indexed fall out.
    """
    prepared = prepare(queries, tables, cfg)
    scope = prepared.resolved.select("qid", "section_id")
    if cfg.mode == "fulltext":
        terms = matching.boolean_terms(prepared.parsed, cfg)
        hits = matching.match_fulltext(
            tables.postings, tables.dictionary, tables.positions, terms, prepared.resolved
        )
        return hits.select("qid", "entry_id")
    hits = matching.match_terms(
        tables.doc_index, prepared.terms, prepared.resolved, cfg, cfg.mode, tables.tokens, tables.pieces
    )
    open_scope = scope.join(prepared.terms.select("qid").distinct(), "qid", "left_anti")
    kept = entries.select("entry_id", "section_id").join(open_scope, "section_id")
    return hits.select("qid", "entry_id").unionByName(kept.select("qid", "entry_id"))
