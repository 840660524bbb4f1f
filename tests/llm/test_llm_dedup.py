import random

import odd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordloom.llm import components, exact_dedup, minhash_dedup
from wordloom.llm.shingles import shingle_set


def normal(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_decisions_on_odd_texts(spark):
    rows = [*odd.TEXTS, (3, "word"), (None, "a b"), (None, "alone")]
    out = exact_dedup.decisions(odd.documents(spark, rows, **odd.CLASHES)).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    want = []
    for own in groups.values():
        known = [i for i in own if i is not None]
        keep = min(known) if known else None
        want += [(i, keep, len(own), i == keep) for i in own]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted([tuple(r)[:4] for r in out], key=key) == sorted(want, key=key)
    assert exact_dedup.decisions(odd.documents(spark, [])).collect() == []


def test_drop_copies_keeps_one_row_of_each_text(spark):
    rows = [*odd.TEXTS, (3, "word"), (None, "a b"), (None, "alone"), (None, "alone")]
    docs = odd.documents(spark, rows, **odd.CLASHES)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    best = {}
    for doc_id, text in rows:
        rank = (doc_id is None, doc_id or 0)
        best[normal(text)] = min(best.get(normal(text), rank), rank)
    assert sorted((i is None, i or 0) for i, _ in kept) == sorted(best.values())


@pytest.mark.parametrize("most", [1, 16_384])
def test_a_full_filter_changes_no_result(spark, monkeypatch, most):
    monkeypatch.setattr(exact_dedup, "MOST_BITMAPS", most)
    monkeypatch.setattr(exact_dedup, "BITMAP_BITS", 64 if most == 1 else 32_768)
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    out = exact_dedup.decisions(odd.documents(spark, rows)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in out} == {
        (i, i % 700, 2 if i % 700 < 300 else 1) for i in range(1000)
    }


def similar(a, b, percent=80):
    shared = len(a & b)
    return bool(a and b) and 100 * shared >= percent * len(a | b)


def brute_components(rows, width):
    sets = {i: set(shingle_set(t or "", width).tolist()) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if i != j and label[j] < label[i] and similar(sets[i], sets[j]):
                    label[i], changed = label[j], True
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies_of_odd_texts(spark, width):
    out = minhash_dedup.near_copies(odd.documents(spark, **odd.CLASHES), width=width).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == brute_components(odd.TEXTS, width)
    assert minhash_dedup.near_copies(odd.documents(spark, []), width=width).collect() == []


def test_near_copies_without_ids_and_repeated_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c"), (None, None)]
    out = minhash_dedup.near_copies(odd.documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in out) == [
        (-1, -1, True), (-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False),
    ]
    kept = minhash_dedup.drop_near_copies(odd.documents(spark, rows, **odd.CLASHES)).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, -1, 1, 1]


def test_a_group_of_copies_of_copies_in_small_blocks(spark, monkeypatch):
    """Similarities around the threshold, so that heads settle a part of the bucket only."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 7)
    monkeypatch.setattr(minhash_dedup, "PER_HEAD", 3)
    draw = random.Random(5)
    base = [f"w{draw.randrange(500)}" for _ in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(draw.randrange(1, 9)):
            words[draw.randrange(60)] = f"x{draw.randrange(40)}"
        rows.append((i, " ".join(words)))
    out = minhash_dedup.near_copies(odd.documents(spark, rows), width=2).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == brute_components(rows, 2)


def test_signatures_estimate_similarity():
    import numpy as np

    draw = np.random.default_rng(3)
    for size, shared in ((5, 3), (60, 30), (400, 300), (2000, 1000)):
        agree = []
        for _ in range(30):
            both = draw.integers(1, 1 << 63, 2 * size - shared, dtype=np.uint64)
            pair = np.concatenate([both[:size], both[size - shared :]])
            a, b = minhash_dedup.signatures(pair, np.array([size, size]))
            assert np.isfinite(a).all()
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - shared / (2 * size - shared)) < 0.05


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark_session, edges):
    frame = spark_session.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(frame).collect()}
    label = {n: n for edge in edges if edge[0] != edge[1] for n in edge}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


@pytest.fixture(scope="session")
def spark_session(spark):
    return spark
