import hashlib
import math
import os
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import odd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from wordloom.llm import elias_fano, fingerprints, license_scan, ngram_lm, queries, toxicity


# Fingerprints.


@given(st.text(max_size=40), st.text(max_size=40), st.data())
def test_spans_and_extensions(a, b, data):
    left, right = (fingerprints.Prefixes(fingerprints.code_points(t)) for t in (a, b))
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    want = len(os.path.commonprefix([a[i:], b[j:]]))
    assert left.common(i, right, j) == want
    length = min(len(a) - i, len(b) - j)
    assert left.same(i, right, j, length) == (a[i : i + length] == b[j : j + length])


def test_likeness():
    of = lambda t: fingerprints.Prefixes(fingerprints.code_points(t)).fingerprint()
    text = "".join(chr(97 + i * i % 26) for i in range(1000))
    assert fingerprints.likeness(of(text), of(text)) == 1
    assert fingerprints.likeness(of(""), of("")) == 1
    assert fingerprints.likeness(of(text), of("")) == 0
    assert 0.6 < fingerprints.likeness(of(text), of(text[:667] + "#" * 333)) < 0.7
    assert fingerprints.likeness(of(text), of(text[::-1])) < 0.2


def test_likeness_of_shifted_near_copies():
    of = lambda t: fingerprints.Prefixes(fingerprints.code_points(t)).fingerprint()
    numbers = random.Random(1)
    text = "".join(numbers.choice("abcdefghij klmnop") for _ in range(100_000))
    other = "".join(numbers.choice("abcdefghij klmnop") for _ in range(100_000))
    assert fingerprints.likeness(of(text), of("#" + text)) > 0.99
    assert fingerprints.likeness(of(text), of(text[:50] + text[51:])) > 0.99
    assert fingerprints.likeness(of(text), of(text[50_000:] + text[:50_000])) > 0.98
    changed = "".join("#" + text[i + 1 : i + 4096] for i in range(0, len(text), 4096))
    assert fingerprints.likeness(of(text), of(changed)) > 0.85
    assert fingerprints.likeness(of(text), of(other)) < 0.01
    for n in (100, 300, 1020, 2040, 4000):
        assert fingerprints.likeness(of(text[:n]), of("#" + text[:n])) > 0.7
        assert fingerprints.likeness(of(text[:n]), of(text[: n // 2] + "#" + text[n // 2 + 1 : n])) > 0.7
    assert 0.45 < fingerprints.likeness(of(text), of(text[25_000:75_000])) <= 0.5


@given(st.text(max_size=600))
def test_cells_cover_the_text(text):
    sizes = fingerprints.cell_sizes(len(text))
    found = fingerprints.Prefixes(fingerprints.code_points(text)).bounds
    for size, bounds in zip(sizes, found, strict=True):
        lengths = [b - a for a, b in zip(bounds, bounds[1:])]
        assert sum(lengths) == len(text) and all(0 < n <= size for n in lengths)


@pytest.mark.parametrize("rows", [odd.TEXTS, odd.TEXTS[:1], [(i, f"text {i} " * i) for i in range(60)]])
def test_compare_with_next(spark, rows):
    out = {r.doc_id: r for r in fingerprints.compare_with_next(odd.documents(spark, rows, **odd.CLASHES)).collect()}
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts, reverse=True)
    assert set(out) == set(order)
    for here, after in zip(order, order[1:] + order[:1]):
        text, third = texts[here], len(texts[here]) // 3
        changed = text[: len(text) - third] + texts[after][:third]
        assert out[here].n_chars == len(text)
        assert out[here].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert out[here].common_next == len(os.path.commonprefix([text, texts[after]]))
        assert (out[here].fingerprint == out[here].edited_fingerprint) == (text == changed)
    assert fingerprints.compare_with_next(odd.documents(spark, [])).collect() == []


def test_repeated_ids_follow_each_other(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, None)]
    out = fingerprints.compare_with_next(odd.documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1) for r in out) == [-1, -1, 1, 1, 2]


# License notices.


def test_scan_of_odd_texts(spark):
    rows = [*odd.TEXTS, (6, odd.TEXTS[6][1]), (None, "CC-BY all rights reserved CC by")]
    out = license_scan.scan(odd.documents(spark, rows, **odd.CLASHES)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert tuple(by_id[0]) == (0, 0, 0, None, None, "", "", 0.0)
    assert tuple(by_id[6])[1:] == (10, 2, 0, 3, "cc-by,reserved", "cc-by,mit,reserved", 1.0)
    assert tuple(by_id[None])[1:6] == (7, 3, 0, 5, "cc-by,reserved")
    assert by_id[-3].base_labels == "gpl"
    assert by_id[12].n_words == 20_000
    assert license_scan.scan(odd.documents(spark, [])).collect() == []


@pytest.mark.parametrize("containment", [0.5, 0.75, 1.0])
def test_every_line_over_the_threshold_is_found(spark, containment):
    templates = (("a b c d", "abcd"), ("c d e", "cde"), ("x", "x"))
    lines = [" ".join(w for k, w in enumerate("abcdex") if m >> k & 1) for m in range(64)]
    out = license_scan.scan(odd.documents(spark, list(enumerate(lines))), templates, containment=containment)
    for row in out.collect():
        words = set(lines[row.doc_id].split())
        want = sorted(
            label for text, label in templates
            if len(words & set(text.split())) >= containment * len(text.split()) - 1e-9
        )
        assert row.labels == ",".join(want)


def test_wrapped_notices_are_found(spark):
    """However a notice is wrapped, with comment signs and blank lines; words far apart are none."""
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy".split()
    made = random.Random(9)
    texts = ["\n".join(notice), "\r\n * ".join(["Some words"] + notice), "x " * 50 + " ".join(notice[:5]) + "\n\n" + " ".join(notice[5:]) + " y" * 50]
    for _ in range(20):
        texts.append("// " + "".join(w + made.choice([" ", " ", "\n", "\n// ", "\n\n"]) for w in ["a", *notice, "b"]))
    apart = ["\n".join([" ".join(notice[:6]) + " x" * 20, " ".join(notice[6:])]), "\n".join(["x " * 20 + w + " x" * 20 for w in notice])]
    out = {r.doc_id: r.labels for r in license_scan.scan(odd.documents(spark, list(enumerate(texts + apart)))).collect()}
    assert all(out[i] == "mit" for i in range(len(texts)))
    assert all(out[len(texts) + i] == "" for i in range(len(apart)))


@pytest.mark.parametrize("reach", [1, 3, 14])
def test_words_around_breaks(spark, reach):
    made = random.Random(reach)
    cases = [[["w%d" % made.randint(0, 99) for _ in range(made.choice([0, 1, 2, 20]))] for _ in range(made.randint(0, 6))] for _ in range(40)]
    table = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id INT, lines ARRAY<ARRAY<STRING>>")
    for r in table.select("id", license_scan.around_breaks(F.col("lines"), reach).alias("got")).collect():
        lines = [line for line in cases[r.id] if line]
        want = [line[-reach:] + [w for later in lines[i + 1 :] for w in later][:reach] for i, line in enumerate(lines[:-1])]
        assert r.got == want


# Elias-Fano and the language model.


@given(st.lists(st.integers(0, 3000), max_size=200), st.lists(st.integers(0, 3000), max_size=40))
def test_elias_fano(values, wanted):
    values = np.array(sorted(values), np.int64)
    made = elias_fano.Sequence(np.frombuffer(elias_fano.encode(values, 3001), np.uint8))
    assert made.get(np.arange(len(values))).tolist() == values.tolist()
    wanted = np.array(wanted, np.int64)
    none, all_ = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(values))
    places = made.find(wanted, none, all_)
    for value, place in zip(wanted.tolist(), places.tolist()):
        assert (place >= 0) == (value in values) and (place < 0 or values[place] == value)
    empty = made.find(wanted, none, none)
    assert (empty == -1).all()


@settings(max_examples=50)
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9))))
def test_trie_finds_successors_in_their_context(pairs):
    keys = np.array(sorted(c * 10 + s for c, s in pairs), np.int64)
    share = (keys + 1) / 200
    trie = ngram_lm.Trie(10, 10, keys, share)
    contexts, names = np.divmod(np.arange(100), 10)
    codes = trie.lookup(contexts, names)
    for key, code in enumerate(codes.tolist()):
        assert (code > 0) == (key in keys)
        if code:
            assert abs((1 - code) / ngram_lm.STEPS - math.log10((key + 1) / 200)) <= 0.5 / ngram_lm.STEPS + 1e-9


def check_scores(rows, out, mu):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None}
    words = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    single, before, pairs = Counter(), Counter(), Counter()
    for i, own in words:
        if not held.get(i, False):
            single.update(own)
            for a, b in zip([b"\n", *own], own):
                before[a] += 1
                pairs[a, b] += 1
    n, v = sum(single.values()), len(single)
    chance = lambda w: (single[w] + 0.1) / (n + 0.1 * (v + 1))
    want = []
    for i, own in words:
        base = sum(math.log10(chance(w)) for w in own)
        score = sum(
            math.log10((pairs[a, b] + mu * chance(b)) / (before[a] + mu)) for a, b in zip([b"\n", *own], own)
        )
        known = sum(single[w] > 0 for w in own)
        want.append(((i is None, i or 0), held.get(i, False), len(own), known, n, base, score))
    got = [((r.doc_id is None, r.doc_id or 0), *tuple(r)[1:]) for r in out]
    for mine, theirs in zip(sorted(got), sorted(want), strict=True):
        assert mine[:5] == theirs[:5]
        assert mine[5] == pytest.approx(theirs[5], abs=1e-6)
        assert abs(mine[6] - theirs[6]) <= theirs[2] * 0.5 / ngram_lm.STEPS + 1e-6


@pytest.mark.parametrize("hot_from", [None, 3])
def test_scores(spark, monkeypatch, hot_from):
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", 50)
    if hot_from:
        made = ngram_lm.word_totals
        monkeypatch.setattr(ngram_lm, "word_totals", lambda sent, _: made(sent, hot_from))
    rows = [*odd.TEXTS, (3, "word"), (None, "word two")]
    out = ngram_lm.score(odd.documents(spark, rows, **odd.CLASHES)).collect()
    check_scores(rows, out, ngram_lm.MU)


def test_scores_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_scores(rows, ngram_lm.score(docs).collect(), ngram_lm.MU)


def test_scores_without_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    out = ngram_lm.score(odd.documents(spark, [(held, "a b")])).collect()
    assert [tuple(r)[:5] for r in out] == [(held, True, 3, 0, 0)]
    assert ngram_lm.score(odd.documents(spark, [])).collect() == []


# Toxicity.


def naive(clause):
    """Factors of the machine, by looking around each word of a clause."""
    t, out = toxicity, []
    for i, symbol in enumerate(clause):
        before, others = clause[:i], clause[:i] + clause[i + 1 :]
        near = clause[max(0, i - t.NEAR) : i] + clause[i + 1 : i + 1 + t.NEAR]
        factor = 1.0
        if symbol in (t.INSULT, t.THREAT):
            factor *= t.NEGATED if t.NEGATION in before[-t.REACH :] else 1.0
            factor *= t.REPORTED if t.REPORT in before else 1.0
            factor *= t.TARGETED if t.TARGET in others else 1.0
        if symbol == t.INSULT and t.INSULT in before[-t.HEAP :]:
            factor *= t.HEAPED
        if symbol == t.THREAT and t.TARGET not in near and t.SELF not in near:
            factor *= t.UNAIMED
        out.append(factor)
    return out


@given(st.lists(st.integers(0, 6), max_size=30))
def test_composed_machine(clause):
    onward, back, factor = toxicity.machine()
    before, behind = [0], [0]
    for symbol in clause:
        before.append(onward[before[-1]][symbol])
    for symbol in reversed(clause):
        behind.append(back[behind[-1]][symbol])
    got = [factor(before[i], symbol, behind[len(clause) - 1 - i]) for i, symbol in enumerate(clause)]
    assert got == pytest.approx(naive(clause))


def test_insults_and_threats_differ():
    given = dict.fromkeys((*toxicity.INSULTS, *toxicity.THREATS), toxicity.GIVEN)
    score = toxicity.clause_scorer(toxicity.Model(words=given))
    one = toxicity.GIVEN
    assert score("kill the process")[0] == one * toxicity.UNAIMED
    assert score("i will kill the process")[0] == one
    assert score("i will kill you")[0] == pytest.approx(one * toxicity.TARGETED)
    assert score("kill it, and much later in this clause you rest")[0] == pytest.approx(
        one * toxicity.UNAIMED * toxicity.TARGETED
    )
    assert score("stupid old clown")[0] == pytest.approx(one * (1 + toxicity.HEAPED))


@pytest.mark.parametrize(
    ("negated", "threat"),
    [
        ("this isn't an idiot", "we shoot"),
        ("das ist kein idiot", "ich werde töten"),
        ("ce n\u2019est guère un imbécile", "j'aime tuer"),
        ("este no es un imbécil", "yo quiero matar"),
    ],
)
def test_four_languages(negated, threat):
    given = dict.fromkeys((*toxicity.INSULTS, *toxicity.THREATS), toxicity.GIVEN)
    score = toxicity.clause_scorer(toxicity.Model(words=given))
    assert score(negated)[0] == toxicity.GIVEN * toxicity.NEGATED
    assert score(threat)[0] == toxicity.GIVEN
    assert score(threat.split()[-1])[0] == toxicity.GIVEN * toxicity.UNAIMED


def test_clauses():
    score = toxicity.clause_scorer(toxicity.Model(words={"idiot": 4.0, "kill": 3.0}, beginnings={"moro": 2.0}))
    assert score("a fine day") == (0.0, 0)
    assert score("idiot")[0] == 4.0
    assert score("not an idiot")[0] == 4.0 * toxicity.NEGATED
    assert score("not this. idiot")[0] == 4.0
    assert score("he said idiot")[0] == pytest.approx(4.0 * toxicity.REPORTED * toxicity.TARGETED)
    assert score("Idiot, you!")[0] == pytest.approx(4.0 * toxicity.TARGETED)
    assert score("morons!\nkill") == (2.0 + 3.0 * toxicity.UNAIMED, 2)
    assert score("idiot. idiot. idiot.") == (4.0, 1)


def test_clauses_of_different_words_of_one_weight_all_count():
    given = dict.fromkeys(toxicity.INSULTS, toxicity.GIVEN)
    score = toxicity.clause_scorer(toxicity.Model(words=given))
    one = toxicity.GIVEN * toxicity.REPORTED * toxicity.TARGETED
    assert score("he said idiot. she wrote moron.") == (pytest.approx(2 * one), 2)
    assert score("he said idiot. she wrote idiot!") == (pytest.approx(one), 1)


def test_learned_words_and_held_out_accuracy(spark):
    docs = spark.createDataFrame(
        [(i, f"plain words number {i} here" + (" bloopa" + "xyz"[i % 3] if i % 4 == 0 else "")) for i in range(800)],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id long, toxic int")
    out = toxicity.scored(docs, labels).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)


def test_every_significant_word_is_learned(spark):
    # 600 insults in 40 toxic texts each, by a pattern of their own.
    name = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(3))
    held = [[] for _ in range(400)]
    for k in range(600):
        for j in range(40):
            held[(k * 7 + j * 10 + k // 400) % 400].append(f"{name(k)}oxlong")
    rows = [(" ".join(words), 1) for words in held] + [(f"plain words of row {i}", 0) for i in range(1200)]
    model = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert all(model.words.get(f"{name(k)}oxlong") for k in range(600))
    assert not any(f"{name(k)}ox" in model.beginnings for k in range(600))


def test_beginnings_with_the_counts_of_a_longer_entry_go(spark):
    rows = [("bloo", 9, 0), ("bloop", 9, 0), ("bloopa$", 9, 0), ("bloops$", 8, 0), ("tram", 7, 1), ("tramp", 7, 0)]
    left = toxicity.without_short_twins(spark.createDataFrame(rows, "feature string, toxic long, clean long"))
    assert sorted(r.feature for r in left.collect()) == ["bloopa$", "bloops$", "tram", "tramp"]


def words_of(text):
    return [toxicity.EDGES.sub("", token) for token in text.lower().split()]


def naive_lexicon(sample):
    """Weights of words and beginnings, from ``(text, toxic)``."""
    sides = (Counter(), Counter())
    for text, toxic in sample:
        held = {w for w in words_of(text) if w}
        sides[toxic].update({w + "$" for w in held} | {w[:n] for w in held for n in (4, 5, 6) if len(w) > n})
    clean, toxic = (sum(1 for _, label in sample if label == side) for side in (0, 1))
    every, strong = set(sides[0]) | set(sides[1]), {}
    for name in every:
        n, p = sides[0][name], sides[1][name]
        want = (p + n) * toxic / (toxic + clean)
        if p > want:
            gain = p * math.log(p / want) + (n * math.log(n / (p + n - want)) if n else 0)
            if gain >= toxicity.CAUTION * math.log(len(every)):
                strong[name] = (p, n)
    given = {w + "$" for w in (*toxicity.INSULTS, *toxicity.THREATS)}
    twins = {long[:n] for long in strong for n in (4, 5, 6) if n < len(long) and strong.get(long[:n]) == strong[long]}
    weights = dict.fromkeys(given, toxicity.GIVEN)
    for name in (set(strong) - twins) | {w for w in given & every if sides[0][w] + sides[1][w] >= 5}:
        n, p = sides[0][name], sides[1][name]
        weights[name] = max(0.0, math.log((p + 0.5) / (toxic + 1) / ((n + 0.5) / (clean + 1))))
    return weights


def naive_evidence(text, weights):
    found, clause = {}, []
    for token in [*text.lower().replace("\n", " . ").split(), "."]:
        word = toxicity.EDGES.sub("", token)
        weight = max([weights.get(word + "$", 0.0), *[weights.get(word[:n], 0.0) for n in (4, 5, 6) if len(word) >= n]])
        plain = word.replace("\u2019", "'")
        kinds = [
            (weight > 0 and word in toxicity.THREATS, toxicity.THREAT),
            (weight > 0, toxicity.INSULT),
            (plain in toxicity.TARGETS, toxicity.TARGET),
            (plain in toxicity.SELVES or plain[:2] == "j'", toxicity.SELF),
            (plain in toxicity.NEGATIONS or plain[-3:] == "n't" or plain[:2] == "n'", toxicity.NEGATION),
            (plain in toxicity.SPEECH, toxicity.REPORT),
            (True, toxicity.OTHER),
        ]
        clause.append((word, weight, next(symbol for holds, symbol in kinds if holds)))
        if toxicity.CLAUSE_END.search(token):
            factors = naive([symbol for _, _, symbol in clause])
            name = tuple(w for w, weight, _ in clause if weight)
            total = sum(weight * f for (_, weight, _), f in zip(clause, factors))
            found[name] = max(total, found.get(name, 0.0))
            clause = []
    return sum(found.values())


def loss(curve, pairs):
    (a, b), out = curve, 0.0
    for evidence, toxic in pairs:
        z = a + b * math.log1p(evidence)
        out += max(z, 0.0) + math.log1p(math.exp(-abs(z))) - toxic * z
    return out + 0.05 * ((a - toxicity.Model.offset) ** 2 + (b - toxicity.Model.slope) ** 2)


def test_whole_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}

    def number(data):
        value = xxhash.xxh64(data, seed=42).intdigest()
        return value - (1 << 64 if value >> 63 else 0)

    first = {}
    for i in sorted(labels):
        if i in docs and labels[i] is not None and not held[i]:
            hashes = {number(w.encode()) for w in re.split(r"[ \t\n\x0b\f\r]+", docs[i])}
            sketch = (min(hashes), min(number(struct.pack("<q", h)) for h in hashes), labels[i])
            first.setdefault(sketch, (docs[i], labels[i]))
    sample = list(first.values())
    weights = naive_lexicon(sample)
    evidence = {i: naive_evidence(text, weights) for i, text in docs.items()}
    model = toxicity.train(spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
                           spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    entries = {w + "$": x for w, x in model.words.items()} | model.beginnings
    assert entries == pytest.approx(weights)
    pairs = [(naive_evidence(text, weights), toxic) for text, toxic in sample]
    curve, step = (model.offset, model.slope), 1e-3
    # The loss is convex: no neighbour is better than the curve that was fitted.
    best = loss(curve, pairs)
    for da, db in [(step, 0), (-step, 0), (0, step), (0, -step), (step, -step), (-step, step)]:
        assert loss((curve[0] + da, curve[1] + db), pairs) >= best
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, folder).collect()}
    assert got.keys() == docs.keys()
    for i, row in got.items():
        score = 1 / (1 + math.exp(-(curve[0] + curve[1] * math.log1p(evidence[i]))))
        assert (row.held_out, row.predicted) == (held[i], int(row.score >= 0.5))
        assert row.score == pytest.approx(score, abs=1e-9)


def test_toxicity_of_odd_texts(spark):
    rows = [*odd.TEXTS, (3, "word"), (None, "you idiot, you pathetic moron")]
    docs = odd.documents(spark, rows, **odd.CLASHES)
    for labels in ([], [(1, None), (None, 1)], [(3, 1), (3, 0), (4, 0), (5, 0)]):
        out = toxicity.scored(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, none)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i is not None)
    assert toxicity.scored(odd.documents(spark, []), none).collect() == []
