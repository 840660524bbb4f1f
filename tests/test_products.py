"""Sums of parts by blocks, against sums pair by pair."""

import random

import pyarrow as pa
import pytest

from wordloom.functions import products
from wordloom.operators import indexing, matching, topk
from wordloom.plans import catalog
from wordloom.session import stored


def tables(seed):
    rand = random.Random(seed)
    parts = [
        (e, e % 3, w, rand.choice([None, 0.0, -0.5]) if rand.random() < 0.05 else rand.random() * 3)
        for e in range(40) for w in range(0, 60, 2) if rand.random() < 0.4
    ]
    parts += [parts[0], (5, 7, 4, 1.0)]
    rand.shuffle(parts)
    queries = [(f"q{i}", rand.sample(range(60), rand.randint(0, 12)), rand.sample(range(3), rand.randint(1, 3))) for i in range(25)]
    return queries, parts


def parts_table(parts):
    columns = list(zip(*parts)) or [()] * 4
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    rows = {n: pa.array(c, k) for n, c, k in zip(("entry_id", "section_id", "word", "part"), columns, kinds)}
    levels = [int((p or 0) * topk.LEVELS // 1) for p in columns[3]]
    return pa.table({**rows, "level": pa.array(levels, pa.int32())})


def sums(queries, parts, looked=lambda q, w, p: True):
    out = {}
    for qid, words, sections in queries:
        for e, s, w, p in parts:
            if w in words and s in sections and looked(qid, w, p):
                out.setdefault((qid, e, s), []).append(p)
    return {k: sum(p for p in v if p is not None) if any(p is not None for p in v) else None for k, v in out.items()}


def got(table):
    return {(r["qid"], r["entry_id"], r["section_id"]): r["relevance"] for r in table.to_pylist()}


def same(a, b):
    assert a.keys() == b.keys()
    assert all(a[k] == b[k] if None in (a[k], b[k]) else abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("cells", [1, 100, 10**6])
def test_all_pairs_and_wanted_ones(monkeypatch, cells):
    monkeypatch.setattr(products, "CELLS", cells)
    lists = {"words": pa.list_(pa.int64()), "sections": pa.list_(pa.int32())}
    for seed in range(5):
        queries, parts = tables(seed)
        columns = {n: pa.array([q[i] for q in queries], lists.get(n)) for i, n in enumerate(("qid", "words", "sections"))}
        same(got(products.block_scores(pa.table(columns), parts_table(parts))), sums(queries, parts))
        for none in (pa.table(columns).slice(0, 0), pa.table(columns)):
            assert products.block_scores(none, parts_table([])).num_rows == 0
        assert products.block_scores(pa.table(columns).slice(0, 0), parts_table(parts)).num_rows == 0
        # An entry's parts count whatever section it is wanted in.
        wanted = pa.array([[{"entry_id": e, "section_id": 9} for e in (3, 8, 99)]] * 25, pa.list_(pa.struct([("entry_id", pa.int64()), ("section_id", pa.int32())])))
        found = got(products.block_scores(pa.table({"qid": columns["qid"], "words": columns["words"], "wanted": wanted}), parts_table(parts)))
        anywhere = sums([(q, w, range(10)) for q, w, _ in queries], [(e, 9, w, p) for e, _, w, p in parts if e in (3, 8, 99)])
        same(found, anywhere)


@pytest.mark.parametrize("cells", [1, 10**6])
def test_bounded_sums_keep_what_could_be_among_the_first(monkeypatch, cells):
    monkeypatch.setattr(products, "CELLS", cells)
    for seed in range(5):
        queries, parts = tables(seed)
        rand = random.Random(seed)
        levels = {(q, w): rand.choice([0, 0, 2, 5, 40, -1]) for q, words, _ in queries for w in words}
        asked = pa.table({
            "qid": pa.array([q[0] for q in queries]),
            "words": pa.array([q[1] for q in queries], pa.list_(pa.int64())),
            "levels": pa.array([[levels[q, w] for w in words] for q, words, _ in queries], pa.list_(pa.int32())),
            "sections": pa.array([q[2] for q in queries], pa.list_(pa.int32())),
            "least": [0.7] * 25, "unmet": [0.4] * 25, "k": [3] * 25, "margin": [0.0] * 25,
        })
        looked = sums(queries, parts, lambda q, w, p: int((p or 0) * topk.LEVELS // 1) >= levels[q, w])
        want = {}
        for qid, *_ in queries:
            seen = {k: v for k, v in looked.items() if k[0] == qid and v is not None}
            best = sorted(seen.values(), reverse=True)
            least = max(0.7, best[2]) if len(best) > 2 else 0.7
            want |= {k: v for k, v in seen.items() if v + 0.4 >= least}
        same(got(products.block_scores(asked, parts_table(parts))), want)


def test_relevance_moves_no_row_for_a_query_an_entry_and_a_word(spark, sf_dir):
    rows = stored(catalog.posting_rows(spark, sf_dir), "postings")
    terms, resolved = catalog.free_text(spark, sf_dir)
    scores = matching.fulltext_relevance(rows, indexing.build_dictionary(rows), terms, resolved)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "hashpartitioning(qid, entry_id" not in plan


def test_candidates_are_cut_where_they_are_found(spark, sf_dir, monkeypatch):
    kept = {}

    def keep(df, purpose):
        kept[purpose] = stored(df, purpose)
        return kept[purpose]

    rows = stored(catalog.posting_rows(spark, sf_dir), "postings")
    terms, resolved = catalog.free_text(spark, sf_dir)
    known = indexing.build_dictionary(rows)
    impacts = topk.build_impacts(rows, 3)
    monkeypatch.setattr(topk, "stored", keep)
    top = topk.fulltext_top(impacts, known, terms, resolved, 3).select("qid", "rank", "relevance").collect()
    every = matching.fulltext_relevance(rows, known, terms, resolved)
    assert 0 < kept["partial-relevance"].count() < every.count()
    best = {}
    for r in every.select("qid", "relevance").collect():
        best.setdefault(r["qid"], []).append(r["relevance"])
    want = {(q, i + 1): v for q, vs in best.items() for i, v in enumerate(sorted(vs, reverse=True)[:3])}
    assert {(r["qid"], r["rank"]): r["relevance"] for r in top} == pytest.approx(want, abs=3e-6)
