"""Laws that tie operators together, on the given tables."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wordloom.config import SectionIndex
from wordloom.operators import completions, indexing, logs, maintenance, matching, querytext, ranking, suggest
from wordloom.plans import catalog, search
from wordloom import session
from wordloom.session import local_table, shared_folder, stored
from wordloom.sources import index_tables
from wordloom.sources import tables as src
from wordloom.streaming import index_feed, log_feed

CFG = src.CONFIG


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def ready(spark, sf_dir):
    return catalog.prepared(spark, sf_dir)


@pytest.mark.parametrize("mode", ["like", "regexp"])
def test_index_matching_equals_scanning(spark, ready, mode):
    prepared, tables = ready
    columns = ("qid", "entry_id", "keywords_matched", "occurrences")
    wide, narrow = replace(CFG, method="scan"), replace(CFG, method="tokens")
    match = lambda cfg: matching.match_terms(
        tables.doc_index, prepared.terms, prepared.resolved, cfg, mode
    )
    assert rows(match(wide), *columns) == rows(match(narrow), *columns)


def test_index_matching_of_odd_terms(spark):
    texts = ["aaaa aa\naaa", "x  y", "of the  end", "often theme", " lead", "the of the", "ünï çödé", "a.b|c(d"]
    index = local_table(
        spark, [(i, 1, t, t) for i, t in enumerate(texts)],
        "entry_id LONG, section_id INT, data STRING, data_lc STRING",
    )
    terms = ["aa", "a", "of the", "the of the", "x  y", "x y", " lead", "ünï", "ï ç", "b|c(", "aaa", "f the  e"]
    table = local_table(spark, [(t,) for t in terms], "term STRING")
    for whole in (False, True):
        scan = matching.scan_hits(index, table, whole)
        found = matching.indexed_hits(index, indexing.build_token_index(index), table, whole)
        columns = ("entry_id", "term", "n", "ok")
        want = [r for r in rows(scan, *columns)]
        assert rows(found, *columns) == want


def test_whole_words_are_substrings_too(spark, sf_dir, ready):
    like = set(rows(catalog.matched(spark, sf_dir), "qid", "entry_id"))
    regexp = set(rows(catalog.matched(spark, sf_dir, catalog.REGEXP), "qid", "entry_id"))
    positive = {q[0] for q in src.QUERIES if "-" not in q[1]}
    assert {r for r in regexp if r[0] in positive} <= like


def test_excluding_never_adds(spark, sf_dir):
    hits = rows(catalog.matched(spark, sf_dir), "qid", "entry_id")
    of = lambda qid: {e for q, e in hits if q == qid}
    assert of(3) <= of(1) and of(3)
    assert not of(3) & of(16)


def test_pages_join_to_the_whole_result(spark, sf_dir):
    scored = catalog.scored(spark, sf_dir).filter("qid = 2").drop("page", "per_page")
    order = ranking.sort_keys(search.rank_value())
    want = [r["entry_id"] for r in scored.orderBy(*order).collect()]
    pages = []
    for page in range(1, len(want) // 40 + 2):
        hits = scored.withColumn("page", F.lit(page)).withColumn("per_page", F.lit(40))
        pages += [r["entry_id"] for r in ranking.paginate(hits, search.rank_value(), 40 * page).orderBy("rank").collect()]
    assert pages == want


def test_reindex_equals_upsert_of_everything(spark, sf_dir):
    index = catalog.doc_rows(spark, sf_dir)
    grown = src.load_contents(spark, sf_dir).withColumn("text", F.upper("text"))
    fresh = indexing.build_doc_index(grown, src.SECTION_CONFIG)
    again = maintenance.reindex_sections(index, grown, src.SECTION_CONFIG, list(src.SECTION_IDS))
    assert rows(maintenance.upsert_entries(index, fresh)) == rows(again)


def test_strict_search_raises(spark, sf_dir, ready):
    _, tables = ready
    queries = src.load_queries(spark)
    with pytest.raises(ValueError, match="Invalid search sections"):
        search.search(queries, tables, CFG, catalog.as_of(), strict=True)


def test_postings_against_brute_force(spark, sf_dir):
    docs = indexing.cleaned(catalog.doc_rows(spark, sf_dir)).collect()
    got = {(r["entry_id"], r["keyword"]): (r["frequency"], r["tf"]) for r in catalog.posting_rows(spark, sf_dir).collect()}
    random.Random(5).shuffle(docs)
    for doc in docs[:40]:
        words = doc["text"].split(" ")
        for word in set(words):
            if (doc["entry_id"], word) in got:
                assert got[doc["entry_id"], word] == (doc["text"].count(word), words.count(word))


def split_events(spark, sf_dir, parts):
    """The events as several files, newest first, so that later batches bring older rows."""
    path = shared_folder(spark, "event-parts")
    events = src.read(spark, sf_dir, "events").orderBy(F.desc("event_id"))
    events.repartitionByRange(parts, F.desc("event_id")).write.parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def index_of(spark, name):
    return index_tables.IndexTables(spark, shared_folder(spark, name), CFG)


def test_index_stream_equals_batch(spark, sf_dir):
    index = index_of(spark, "index")
    index.build(catalog.doc_rows(spark, sf_dir))
    note = lambda last: catalog.changed_entries(spark, sf_dir, last)
    stream = src.change_rows(split_events(spark, sf_dir, 3))
    index_feed.stream_index(stream, index, note, src.SECTION_CONFIG, shared_folder(spark, "c")).awaitTermination()
    want = rows(catalog.upsert_entries(spark, sf_dir))
    columns = ("entry_id", "section_id", "data")
    assert rows(index.table("doc_index"), *columns) == want
    live = stored(index.table("doc_index"), "live")
    want_postings = rows(indexing.build_postings(live, CFG))
    assert rows(index.table("postings").select("entry_id", "section_id", "keyword", "frequency", "tf")) == want_postings
    assert rows(index.table("tokens").select("entry_id", "token", "times")) == rows(
        indexing.build_token_index(live).select("entry_id", "token", "times")
    )
    # Each token has its pieces once; those of tokens that are gone may stay.
    pieces, needed = rows(index.read("pieces")), rows(matching.build_pieces(index.table("tokens")))
    assert len(pieces) == len(set(pieces)) and set(needed) <= set(pieces)

    # Repeating a batch changes nothing.
    index.apply(src.change_rows(src.read(spark, sf_dir, "events")), note, src.SECTION_CONFIG)
    assert rows(index.table("doc_index"), *columns) == want


def test_log_stream_equals_batch(spark, sf_dir):
    path = shared_folder(spark, "groups")
    stream = src.log_rows(split_events(spark, sf_dir, 3))
    log_feed.stream_log_groups(stream, path, shared_folder(spark, "c")).awaitTermination()
    columns = ("keywords", "session_id", "date", "keywords_manipulated", "sections", "results", "depth")
    want = rows(logs.log_groups(src.load_search_logs(spark, sf_dir)), *columns)
    assert rows(log_feed.stored_log_groups(spark, path), *columns) == want
    # A repeated batch changes nothing, and each group is stored once.
    log_feed.fold_log_groups(src.load_search_logs(spark, sf_dir).filter("page > 1"), path)
    assert rows(log_feed.stored_log_groups(spark, path), *columns) == want
    assert spark.read.parquet(path).count() == len(want)


class Cluster:
    """A session that looks like one on a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master, applicationId = "yarn", "app-1"


def test_a_cluster_needs_a_shared_folder(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster, "x")
    folder = session.run_folder(spark)
    assert shared_folder(spark, "x").startswith(f"{folder}/x-")


def test_every_section_counts_however_many(spark):
    index = spark.range(30_000).select(
        F.col("id").alias("entry_id"), F.col("id").cast("int").alias("section_id"),
        F.lit("a").alias("data"), F.lit("a").alias("data_lc"),
    )
    resolved = index.filter("section_id % 2 = 0").select(F.lit(1).alias("qid"), "section_id")
    kept = matching.in_sections(index, resolved)
    assert kept.columns == index.columns
    assert kept.agg(F.count("*"), F.max(F.col("section_id") % 2)).first()[:] == (15_000, 0)


def index_rows(spark, rows_):
    return local_table(spark, rows_, "entry_id LONG, section_id INT, data STRING, data_lc STRING")


def changes(spark, *rows_):
    made = local_table(spark, rows_, "entry_id LONG, day STRING, change_id LONG, op STRING")
    return made.select("entry_id", F.to_timestamp("day").alias("changed_at"), "change_id", "op")


def test_sections_that_entries_leave(spark):
    index = index_of(spark, "moved")
    index.build(index_rows(spark, [(1, 1, "old text", "old text"), (2, 2, "other", "other")]))
    config = [SectionIndex(i, ("text",)) for i in (1, 2, 3)]
    moved = local_table(spark, [(1, 3, "new text")], "entry_id LONG, section_id INT, text STRING")
    for _ in range(2):
        index.apply(changes(spark, (1, "2024-01-05", 5, "edit")), lambda _: moved, config)
        assert rows(index.table("doc_index"), "entry_id", "section_id", "data") == [(1, 3, "new text"), (2, 2, "other")]
        assert {(r["section_id"], r["keyword"]) for r in index.table("postings").collect()} == {
            (3, "new"), (3, "text"), (2, "other")
        }
    # The last entry of a section goes; an older change loses, also against a delete.
    index.delete_entries(local_table(spark, [(2,)], "entry_id LONG"), F.to_timestamp(F.lit("2024-01-09")))
    late = local_table(spark, [(2, 2, "late"), (1, 2, "late")], "entry_id LONG, section_id INT, text STRING")
    older = changes(spark, (2, "2024-01-08", 9, "edit"), (1, "2024-01-05", 4, "edit"))
    index.apply(older, lambda last: late.join(last, "entry_id", "left_semi"), config)
    assert rows(index.table("doc_index"), "entry_id", "section_id", "data") == [(1, 3, "new text")]
    assert rows(index.table("tokens"), "entry_id", "token") == [(1, "new"), (1, "text")]


def test_stored_maintenance(spark, sf_dir):
    index = index_of(spark, "index")
    index.build(catalog.doc_rows(spark, sf_dir))
    columns = ("entry_id", "section_id", "data")
    index.delete_section(3)
    assert rows(index.table("doc_index"), *columns) == rows(catalog.delete_section(spark, sf_dir))
    entries = src.load_contents(spark, sf_dir).withColumn("text", F.concat_ws(" ", "text", "lang"))
    entries = entries.filter("entry_id % 7 <> 0")
    index.reindex_sections(entries, src.SECTION_CONFIG, [2, 3, 5])
    want = maintenance.reindex_sections(catalog.doc_rows(spark, sf_dir), entries, src.SECTION_CONFIG, [2, 3, 5])
    assert rows(index.table("doc_index"), *columns) == rows(want, *columns)
    # The lists of suggestions follow the sections that have changed.
    totals = indexing.keyword_totals(index.table("postings"))
    assert rows(index.table("totals"), *totals.columns) == rows(totals)
    lists = completions.build_completions(totals, CFG.suggest_limit)
    held = index.table("completions").select(*lists.columns)
    assert held.count() == lists.count() and held.exceptAll(lists).isEmpty()
    words = catalog.typed_words(spark, sf_dir)
    resolved = querytext.resolve_sections(words, src.load_sections(spark, sf_dir), CFG)
    found = suggest.suggest_prefix(words, totals.select("keyword").distinct())
    want = suggest.suggest_topk(suggest.suggest_frequency(found, totals, resolved), CFG, "frequency")
    assert rows(index.complete(words, resolved, "frequency"), *want.columns) == rows(want)


@pytest.mark.parametrize("folder", [False, True])
def test_streams_read_a_file_or_a_folder(spark, sf_dir, folder):
    path = shared_folder(spark, "stream-in")
    events = src.read(spark, sf_dir, "events")
    if folder:
        events.repartition(3).write.parquet(f"{path}/events.parquet")
    source = path if folder else sf_dir
    groups = shared_folder(spark, "groups")
    feed = log_feed.stream_log_groups(
        src.log_rows(catalog.event_stream(spark, source)), groups, shared_folder(spark, "c"), {"availableNow": True}
    )
    feed.awaitTermination()
    want = rows(logs.log_groups(src.load_search_logs(spark, sf_dir)), "keywords", "session_id", "results")
    assert rows(log_feed.stored_log_groups(spark, groups), "keywords", "session_id", "results") == want


def test_settings_that_no_search_knows(spark, ready):
    _, tables = ready
    odd = src.load_queries(spark).filter("qid = 1").withColumn("sort", F.lit("nosuch"))
    with pytest.raises(ValueError, match="sort"):
        search.search(odd, tables, CFG, catalog.as_of(), strict=True)
    odd = src.load_queries(spark).filter("qid = 1").withColumn("direction", F.lit("sideways"))
    with pytest.raises(ValueError, match="direction"):
        search.search(odd, tables, CFG, catalog.as_of(), strict=True)


def test_append_settings_mark_the_words(spark, sf_dir):
    cfg = replace(catalog.FULLTEXT, append_all_words_required=True, append_wildcard=True)
    tables = catalog.search_tables(spark, sf_dir, cfg)
    queries = src.load_queries(spark).filter("qid = 2")
    terms = matching.boolean_terms(search.prepare(queries, tables, cfg).parsed, cfg)
    assert rows(terms, "sign", "word", "prefix") == [("+", "the", True), ("+", "tion", True)]


def test_search_run_gives_what_the_parts_give(spark, sf_dir):
    tables = catalog.search_tables(spark, sf_dir)
    tables = replace(tables, dictionary=catalog.dictionary(spark, sf_dir))
    queries = src.load_queries(spark)
    run = search.search_run(queries, tables, CFG, catalog.as_of(), F.lit("s"), F.lit(100))
    assert rows(run.page, "qid", "rank", "entry_id") == rows(catalog.sort_modes(spark, sf_dir))
    assert rows(run.totals) == rows(catalog.found_rows(spark, sf_dir))
    assert rows(run.excerpts, "qid", "entry_id", "excerpt") == rows(catalog.excerpt_html(spark, sf_dir), "qid", "entry_id", "excerpt")
    assert {r["id"] for r in run.log.collect()} == {100 + q[0] for q in src.QUERIES if q[0] != 13}


def test_highlight_has_stems(spark):
    queries = local_table(spark, [(1, 'filters "two words" the')], "qid INT, adjusted STRING")
    parsed = querytext.highlight_stems(querytext.classify(queries, CFG))
    assert parsed.first()["highlight"] == ["two words", "filters", "filter", "the"]
