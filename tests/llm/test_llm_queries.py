"""The registered queries against their SQL, and the pipeline against a plain version of it."""

import odd
import pytest
from compare import differences, oracle_connection
from test_llm_bpe_packing import check_packing, tokenizer
from test_llm_dedup import brute_components, normal

import corpus_pipeline
from wordloom.llm import toxicity
from wordloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    message, rows = differences(QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), ORACLES[name])
    assert message is None and rows > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_has_a_row_for_each_document(spark, sf_dir, name):
    table, key = ("pages", "page_id") if name.startswith("op5_") else ("documents", "doc_id")
    want = {r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()}
    got = QUERIES[name](spark, sf_dir)
    assert {r[0] for r in got.select(key).collect()} == want


@pytest.mark.parametrize("name", ["op2_license_scan", "op3_exact_dedup", "op5_url_filter", "op9_minhash_dedup"])
def test_no_pairs_of_everything(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name != "op9_minhash_dedup":
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.scored(docs, labels).filter("predicted = 1").collect()}
    left = {i: t for i, t in texts.items() if i not in toxic}
    first = {}
    for i in sorted(left):
        first.setdefault(normal(left[i]), i)
    left = {i: left[i] for i in first.values()}
    near = brute_components(list(left.items()), 5)
    left = {i: t for i, t in left.items() if near[i][2]}
    encode = tokenizer()
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert check_packing(rows, {i: encode(t) for i, t in left.items()}) < 0.02


def test_stages_on_odd_tables(spark, sf_dir):
    for rows in ([], odd.TEXTS):
        docs = odd.documents(spark, rows, **odd.CLASHES)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert bool(out.collect()) == bool(rows)
