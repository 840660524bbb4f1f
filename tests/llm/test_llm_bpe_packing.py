import hashlib
import zlib
from collections import defaultdict

import numpy as np
import odd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordloom.llm import bpe, packing
from wordloom.llm.queries import byte_bpe, packed


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe()


@pytest.fixture(scope="module")
def reference(vocabulary):
    import tiktoken

    tokens, pattern = vocabulary
    ranks = {token: rank for rank, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text_encodes_as_the_library_does(text):
    tokens, pattern = byte_bpe()
    import tiktoken

    ranks = {token: rank for rank, token in enumerate(tokens)}
    encoding = _kept.setdefault(
        "e", tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    )
    encode = _kept.get("own") or _kept.setdefault("own", bpe.encoder(bpe.write_model(tokens), pattern))
    ids = np.frombuffer(encode(text), "<u4").tolist()
    assert ids == encoding.encode_ordinary(text)
    assert b"".join(tokens[i] for i in ids) == text.encode()


_kept: dict = {}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=255)))
def test_both_patterns_cut_alike(text):
    import regex

    assert bpe.splitter(bpe.GENERAL_PIECES)(text) == regex.findall(bpe.GENERAL_PIECES, text)


def test_encode_and_decode(spark, vocabulary, reference):
    docs = odd.documents(spark, [*odd.TEXTS, (3, "word"), (None, "x")], **odd.CLASHES)
    tokens, pattern = vocabulary
    rows = bpe.digests(bpe.decode(bpe.encode(docs, tokens, pattern), tokens)).collect()
    want = []
    for doc_id, text in [*odd.TEXTS, (3, "word"), (None, "x")]:
        ids = reference.encode_ordinary(text or "")
        want.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    empty = bpe.digests(bpe.decode(bpe.encode(docs.limit(0), tokens, pattern), tokens))
    assert empty.collect() == []


@given(st.integers(1, 5000))
def test_cuts_cover_a_length_and_fit_their_class(length):
    pieces = packing.cuts(length, 1024)
    assert sum(pieces) == length
    for piece in pieces:
        k = 1024 // piece
        assert k * piece <= 1024
        assert piece < packing.SHORT or 1024 - k * piece <= 1024 * packing.WASTE + k


def check_packing(rows, ids_of):
    """Every id in exactly one piece, no gaps; the share of padding."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
        data = np.array(ids_of[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(data)
        assert r.doc_tokens == len(ids_of[r.doc_id])
    assert set(pieces) == set(ids_of)
    for doc_id, own in pieces.items():
        own.sort(key=lambda r: r.start)
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]]))
        assert sum(r.length for r in own) == len(ids_of[doc_id])
    padding = total = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]]))
        used = sum(r.length for r in own)
        assert used <= 1024
        padding += 0 if used & (used - 1) == 0 else 1024 - used
        total += used
    return padding / total


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids + [0]


def test_packing_of_odd_texts(spark):
    encode = tokenizer()
    docs = odd.documents(spark, **odd.CLASHES)
    check_packing(packed(docs).collect(), {i: encode(t) for i, t in odd.TEXTS})
    assert packed(docs.limit(0)).collect() == []
    twice = packed(odd.documents(spark, [(1, "a b"), (1, "a b"), (None, None)])).collect()
    assert sum(r.length for r in twice if r.doc_id == 1) == 6
    assert [(r.length, r.doc_tokens) for r in twice if r.doc_id is None] == [(1, 1)]


def test_packing_of_documents(spark, sf_dir):
    encode = tokenizer()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id: encode(r.text) for r in docs.collect()}
    assert check_packing(packed(docs).collect(), ids) < 0.02
