"""Properties of the physical plans."""

import os
import re

import pytest

from pyspark.sql import functions as F

from wordloom.operators import indexing, logs, matching, querytext, ranking, suggest
from wordloom.operators.maintenance import delete_entries
from wordloom.plans import catalog
from wordloom.session import TEXT_PARTITIONS, joinable, run_folder, shared_folder, stored
from wordloom.sources import index_tables
from wordloom.sources import tables as src


def final_plan(df):
    """The plan after adaptive execution, without the plan it started from."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def shuffled_columns(plan):
    """Names of the columns that go through shuffles keyed by columns."""
    names = []
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and at + 1 < len(lines):
            names.append(lines[at + 1])
    return "\n".join(names)


@pytest.mark.parametrize(
    "name",
    ["match_like", "match_regexp", "match_fulltext", "search", "hydrate_entries", "upsert_entries"],
)
def test_texts_are_not_shuffled_by_key(spark, sf_dir, name):
    moved = shuffled_columns(final_plan(catalog.QUERIES[name](spark, sf_dir)))
    assert not re.search(r"\b(data|data_lc|text)#", moved)


def test_postings_are_one_narrow_pass(spark, sf_dir, tmp_path):
    path = str(tmp_path / "index")
    catalog.doc_rows(spark, sf_dir).write.partitionBy("section_id").parquet(path)
    plan = final_plan(indexing.build_postings(spark.read.parquet(path), src.CONFIG))
    assert "Exchange" not in plan
    assert plan.count("MapInArrow") == 1


def test_sections_keep_the_texts_in_place(spark, sf_dir, tmp_path):
    path = str(tmp_path / "index")
    catalog.doc_rows(spark, sf_dir).write.partitionBy("section_id").parquet(path)
    prepared, _ = catalog.prepared(spark, sf_dir)
    plan = final_plan(matching.in_sections(spark.read.parquet(path), prepared.resolved))
    assert "BroadcastHashJoin" in plan
    assert not re.search(r"\b(data|data_lc|text)#", shuffled_columns(plan))


def test_no_text_is_dealt_out_unless_asked(spark, sf_dir):
    spark.conf.unset(TEXT_PARTITIONS)
    try:
        for name in ("search", "match_like", "load_entries"):
            assert "RoundRobin" not in final_plan(catalog.QUERIES[name](spark, sf_dir)), name
    finally:
        spark.conf.set(TEXT_PARTITIONS, "4")


def test_pages_are_cut_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in final_plan(catalog.QUERIES["search"](spark, sf_dir))


def test_no_driver_loops_in_operators():
    folder = os.path.join(os.path.dirname(indexing.__file__))
    for name in os.listdir(folder):
        if name.endswith(".py"):
            with open(os.path.join(folder, name)) as file:
                text = file.read()
            assert not re.search(r"\.(collect|toArrow|toPandas|isEmpty)\(", text), name


def test_scan_reads_only_what_it_needs(spark, sf_dir, tmp_path):
    path = str(tmp_path / "index")
    catalog.doc_rows(spark, sf_dir).write.partitionBy("section_id").parquet(path)
    terms = spark.sql("SELECT 'the' AS term")
    plan = matching.scan_hits(spark.read.parquet(path), terms, False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<entry_id:bigint,data_lc:string>" in text
    assert not re.search(r"Exchange (hash|Round|range)", text)


def test_log_page_is_a_top_k(spark, sf_dir):
    groups = logs.log_groups(src.load_search_logs(spark, sf_dir))
    assert "TakeOrderedAndProject" in final_plan(logs.log_page(groups, "date", "desc", 2, 20))


def test_suggestions_are_cut_before_the_shuffle(spark, sf_dir):
    plan = final_plan(catalog.QUERIES["suggest_topk"](spark, sf_dir))
    assert "WindowGroupLimit" in plan


def test_only_postings_use_python(spark, sf_dir):
    for name in ("search", "classify_keywords", "log_groups", "stem_words", "match_like_batch"):
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Python|InPandas|InArrow", plan), name


def test_many_rows_are_not_broadcast(spark):
    few, many = spark.range(1000), spark.range(300_000).select((F.col("id") % 10).alias("id"))
    rows = spark.range(10_000_000).select("id")
    assert "BroadcastHashJoin" in final_plan(rows.join(joinable(stored(few, "few")), "id"))
    assert "BroadcastHashJoin" not in final_plan(few.join(joinable(stored(many, "many")), "id", "left_semi"))


def test_hits_do_not_meet_queries_times_sections(spark, sf_dir):
    words = src.load_user_words(spark, sf_dir).withColumn("sections", F.lit(""))
    sections = stored(src.load_sections(spark, sf_dir), "sections")
    resolved = stored(querytext.resolve_sections(words, sections, catalog.FULLTEXT), "every-section")
    terms = words.select("qid", F.col("qid").alias("term"), F.lit(False).alias("excluded"))
    index = catalog.doc_rows(spark, sf_dir)
    postings = stored(catalog.posting_rows(spark, sf_dir), "postings")
    free = matching.boolean_terms(words, catalog.FULLTEXT, "keywords")
    results = [
        matching.match_terms(index, terms, resolved, catalog.BATCH),
        matching.fulltext_relevance(postings, indexing.build_dictionary(postings), free, resolved),
    ]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        for result in results:
            plan = result._jdf.queryExecution().executedPlan().toString()
            assert not [line for line in plan.splitlines() if "every-section" in line and "qid" in line]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_index_is_not_written_aside(spark, sf_dir):
    def folders():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
        return {f.getPath().getName() for f in files}

    index = index_tables.IndexTables(spark, shared_folder(spark, "written-once"), catalog.CFG)
    stored(spark.range(1), "first")
    before = folders()
    index.build(catalog.doc_rows(spark, sf_dir))
    index.delete_entries(spark.range(20).select(F.col("id").alias("entry_id")), catalog.as_of())
    new = {name.rsplit("-", 1)[0] for name in folders() - before}
    assert "written-once" in new and not new & {"postings", "tokens", "doc_index"}
    left = delete_entries(catalog.posting_rows(spark, sf_dir), spark.range(20).select(F.col("id").alias("entry_id")))
    columns = ("entry_id", "section_id", "keyword", "frequency", "tf")
    assert sorted(index.table("postings").select(*columns).collect()) == sorted(left.select(*columns).collect())


def test_full_text_tables_are_made_from_texts_cleaned_once(spark, sf_dir, monkeypatch):
    made = []
    cleaned = indexing.cleaned
    monkeypatch.setattr(indexing, "cleaned", lambda index: made.append(1) or cleaned(index))
    catalog.search_tables(spark, sf_dir, catalog.FULLTEXT)
    assert len(made) == 1


def test_phrases_move_only_the_places_of_their_words(spark, sf_dir):
    positions = stored(indexing.build_positions(catalog.doc_rows(spark, sf_dir)), "every-place")
    hits = matching.phrase_hits(positions, spark.createDataFrame([("of the",)], "phrase STRING"))
    assert hits.inputFiles() and not [f for f in hits.inputFiles() if "every-place" in f]


def test_nearest_keywords_are_combined_without_a_sort(spark, sf_dir, monkeypatch):
    rings = []

    def kept(df, purpose):
        if purpose == "ring":
            rings.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, purpose)

    monkeypatch.setattr(suggest, "stored", kept)
    words, known = catalog.turn_words(spark, sf_dir), catalog.dictionary(spark, sf_dir)
    nearest = suggest.nearest_by_rings(words, known).drop("compared")
    assert rings and not [plan for plan in rings if "SortAggregate" in plan]
    least = F.min(F.struct("distance", "alternative")).alias("best")
    want = suggest.soundalikes(words, known).groupBy("word").agg(least).select("word", "best.alternative", "best.distance")
    assert sorted(nearest.collect()) == sorted(want.collect())


def test_hits_of_a_batch_are_moved_once_by_entry(spark, sf_dir):
    words = src.load_user_words(spark, sf_dir).withColumn("sections", F.lit(""))
    sections = stored(src.load_sections(spark, sf_dir), "sections")
    resolved = stored(querytext.resolve_sections(words, sections, catalog.BATCH), "query-sections")
    terms = stored(words.select("qid", F.col("qid").alias("term"), F.lit(False).alias("excluded")), "word-terms")
    hits = matching.match_terms(catalog.doc_rows(spark, sf_dir), terms, resolved, catalog.BATCH)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(entry_id") == 1
    assert "hashpartitioning(qid" not in plan


def test_scored_hits_of_a_batch_meet_no_table_of_all_queries(spark, sf_dir):
    tables = catalog.search_tables(spark, sf_dir)
    words = src.load_user_words(spark, sf_dir).select(
        "qid", "keywords", F.lit("").alias("sections"), F.lit("score").alias("sort"), F.lit("desc").alias("direction"),
        F.lit(1).alias("page"), F.lit(5).alias("per_page"),
    )
    ready = catalog.plans.prepare(words, tables, catalog.BATCH)
    hits = catalog.plans.scored_hits(ready, tables, catalog.BATCH, catalog.as_of())
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(qid" not in plan
    assert not [line for line in plan.splitlines() if "FileScan" in line and "per_page" in line and "qid" in line]
    # Hits that lie by entry have each slot of a page in one task.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(1000).select(F.col("id").alias("entry_id"), F.lit(1).alias("qid"), F.lit("id").alias("sort"))
    rows = rows.withColumns({"direction": F.lit("asc"), "page": F.lit(1), "per_page": F.lit(3), "creation_date": F.current_timestamp()})
    lies = rows.repartition(width, "entry_id").withColumn("task", F.spark_partition_id())
    slot = F.pmod(F.hash("entry_id"), F.lit(width))
    assert lies.filter(slot != F.col("task")).count() == 0
    assert "pmod(hash(entry_id" in ranking.paginate(rows, F.lit(0.0), 3)._jdf.queryExecution().analyzed().toString()
