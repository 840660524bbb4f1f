"""Hand-written edge rows."""

import datetime
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wordloom.config import SearchConfig, SectionIndex
from wordloom.functions import counting
from wordloom.functions import text as tx
from wordloom.functions.scoring import weight_factor
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
    spans,
    suggest,
    topk,
)
from wordloom.session import local_table, stored
from wordloom.streaming import log_feed

CFG = SearchConfig()


def one(spark, value, expression):
    df = local_table(spark, [(value,)], "v STRING")
    return df.select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "word, stem",
    [
        ("filters", "filter"), ("filtering", "filter"), ("harmony", "harmoni"),
        ("entry", "entri"), ("summary", "summari"), ("summarise", "summaris"),
        ("relational", "relat"), ("hopping", "hop"), ("agreed", "agre"), ("is", "is"),
        ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("hoping", "hope"),
        ("falling", "fall"), ("sky", "sky"), ("happy", "happi"), ("adoption", "adopt"),
        ("controlling", "control"), ("yes", "ye"), ("oscillate", "oscil"),
    ],
)
def test_stem(spark, word, stem):
    words = local_table(spark, [(word,)], "keyword STRING")
    assert stem_vocabulary(words).first()["stem"] == stem


def test_stem_conditions_stay_above_the_steps(spark):
    words = local_table(spark, [("filters",), ("the",)], "keyword STRING")
    changed = stem_vocabulary(words).filter("stem != keyword")
    assert [r["keyword"] for r in changed.collect()] == ["filters"]


@pytest.mark.parametrize(
    "text, clean",
    [
        (
            "Hello, \"world\" -- it's e.g. [x] http://a.b/c?d=1&e=2 - -5 --5 $3 C++ §x “q” don't. (par) end.",
            "hello world it's e.g x http://a.b/c?d=1&e=2 -5 -5 $3 c++ x q don't par end",
        ),
        ("", ""),
        ("...", ""),
        ("a\tb\nc", "a b c"),
    ],
)
def test_strip_punctuation(spark, text, clean):
    assert one(spark, text, lambda c: F.trim(tx.strip_punctuation(F.lower(c)))) == clean


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a</p>b", "ab"),
        ('<a title="x>y">z</a>', "z"),
        ("a < b", "a < b"),
        ("x<!-- a > b -->y", "xy"),
        ("x<br", "x"),
        ("<p class='a", ""),
        ("<" + "a " * 20000 + ">tail", "tail"),
        ("<b " + 'x="1" ' * 20000 + ">tail", "tail"),
    ],
)
def test_strip_tags(spark, html, text):
    assert one(spark, html, tx.strip_tags) == text


@pytest.mark.parametrize(
    "raw, decoded",
    [
        ("a&#65;b&#x42;", "aAbB"), ("&#233;&#xE9;", "éé"), ("&#128512;", "😀"),
        ("&#0;&#x110000;&#xD800;", "&#0;&#x110000;&#xD800;"), ("&#;&#x;&# 1;", "&#;&#x;&# 1;"),
        ("none", "none"), ("&#99999999999;", "&#99999999999;"),
    ],
)
def test_decode_entities(spark, raw, decoded):
    assert one(spark, raw, tx.decode_entities) == decoded


@pytest.mark.parametrize(
    "raw, decoded",
    [
        ("&#38;#65;&#65;", "&#65;A"), ("&#35;&#65;&#x41;", "#AA"), ("&#6&#53;;&#65;", "&#65;A"),
        ("&#65;&#0;&#65;", "A&#0;A"), ("&#&#65;;", "&#A;"), ("&#x41;&#X41;&#65", "AA&#65"),
        ("".join(f"&#{i};" for i in range(200, 400)), "".join(map(chr, range(200, 400)))),
    ],
)
def test_decoded_characters_make_no_references(spark, raw, decoded):
    assert one(spark, raw, tx.decode_entities) == decoded


def test_digits_of_a_reference_are_read_once(spark):
    texts = spark.range(1).select(F.concat(F.lit("&#65;"), "id").alias("v"))
    plan = texts.select(tx.decode_entities(F.col("v")).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract(") == 1


def test_repair_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"\xc3\xa9"),), (bytearray(b"\xe9"),)], "v BINARY")
    assert [r["r"] for r in df.select(tx.repair_utf8(F.col("v")).alias("r")).collect()] == ["é", "é"]


def test_flatten_text(spark):
    df = spark.range(1).select(
        F.struct(
            F.lit("t").alias("title"),
            F.struct(F.lit("x").alias("a"), F.lit(None).cast("string").alias("b")).alias("nested"),
            F.array(F.lit("p"), F.lit("q")).alias("tags"),
            F.create_map(F.lit("k"), F.lit(3)).alias("more"),
        ).alias("c")
    )
    flat = tx.flatten_text("c", df.schema["c"].dataType)
    assert df.select(flat.alias("r")).first()["r"] == "t x  p q  3   "


def test_token_rules(spark):
    tokens = [
        "ab", "abc", "x" * 29, "x" * 30, "ééé", "a=b", "$xy", "/path", "a->b", "a::b", "lt;x",
        "x&gt", "a/b", "é" * 15,
    ]
    df = local_table(spark, [(t,) for t in tokens], "w STRING")
    kept = [r["w"] for r in df.filter(indexing.is_keyword(F.col("w"), CFG)).collect()]
    assert kept == ["abc", "x" * 29, "ééé", "a/b"]


# The seven passes that the cleaner is defined by, one after another.
SIGN_PASSES = (
    r"[\p{Z}\p{Cc}\p{Cf}\p{Cs}\p{Pi}\p{Pf}]",
    rf"\p{{Po}}(?<![{tx.SPECIAL_QUOTES}{tx.NUMBER_SEPARATORS}{tx.URL_ANY}{tx.NUMBER_MODIFIERS}])",
    rf"[\p{{Ps}}\p{{Pe}}](?<![{tx.URL_BRACKETS}])",
    rf"[{tx.SPECIAL_QUOTES}{tx.NUMBER_SEPARATORS}{tx.URL_AFTER_SPACE}\p{{Pd}}\p{{Pc}}]+((?= )|$)",
    rf"((?<= )|^)[{tx.SPECIAL_QUOTES}{tx.URL_BEFORE_SPACE}\p{{Pc}}]+",
    r"((?<= )|^)\p{Pd}+(?![\p{N}\p{Sc}])",
    r" +",
)


def test_few_punctuation_passes_do_what_seven_did(spark):
    assert len(tx.PUNCTUATION_PASSES) <= 4
    rng = random.Random(3)
    signs = list("!\"#%&'()*,-./:;?@[\\]_{}<>$+=|~`^") * 2 + list("–—―‿﹍“”‘’»…、％٫′€²½\u00a0\u0085\u2028\t\n\U00010ead\U0001f600\U0001d7ce")
    pool = signs + [" "] * 40 + list("ab5é") * 8
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(20000)]
    texts += ["".join(rng.choice(" -%*.'a5$—") for _ in range(rng.randint(0, 9))) for _ in range(20000)]
    texts += [f"a{c}b {c}b a{c} {c}" for c in map(chr, range(0x3100)) if c not in "\0"]
    rows = local_table(spark, [(t,) for t in texts], "t STRING")
    wanted = F.col("t")
    for pattern in SIGN_PASSES:
        wanted = F.regexp_replace(wanted, pattern, " ")
    both = rows.select("t", wanted.alias("wanted"), tx.strip_punctuation(F.col("t")).alias("got"))
    assert both.filter("wanted != got").collect() == []


def test_postings_count_substrings_and_tokens(spark):
    index = local_table(
        spark,
        [(1, 1, "the other the", "the other the"), (2, 1, "aaaa aaa", "aaaa aaa"), (3, 1, "", "")],
        "entry_id LONG, section_id INT, data STRING, data_lc STRING",
    )
    got = {(r["entry_id"], r["keyword"]): (r["frequency"], r["tf"]) for r in indexing.build_postings(index, CFG).collect()}
    assert got == {(1, "the"): (3, 2), (1, "other"): (1, 1), (2, "aaaa"): (1, 1), (2, "aaa"): (2, 1)}


def test_keywords_come_joined_to_the_counting():
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(12)) for _ in range(300)]
    keywords = [[w for w in dict.fromkeys(t.split(" ")) if len(w) > 1] for t in texts]
    batch = pa.RecordBatch.from_pydict(
        {
            "entry_id": pa.array(range(301), pa.int64()),
            "section_id": pa.array([1] * 301, pa.int32()),
            "text": [*texts, "a"],
            "keywords": [*(" ".join(k) for k in keywords), None],
        }
    )
    got = [tuple(row.values()) for part in counting.count_batches([batch]) for row in part.to_pylist()]
    assert got == [
        (i, 1, k, t.count(k), t.split(" ").count(k)) for i, (t, ks) in enumerate(zip(texts, keywords)) for k in ks
    ]


def test_keywords_are_told_where_they_are_counted(spark):
    """By the same rule as the column expression; only the texts go to Python."""
    made = random.Random(8)
    signs = ["lt;", "$", "/", "&gt", "&lt;", "&gt;", "=", "->", "::", "-", ">", ":", "&", ";", "lt", "gt"]
    word = lambda: "".join(made.choice(signs + list("abé中\U0001f600") * 6) for _ in range(made.randint(1, 6)))
    texts = [" ".join(word() for _ in range(made.randint(1, 9))) for _ in range(400)]
    texts += [c * n for c in "aé中\U0001f600" for n in range(1, 33)] + ["", "lt;abc", "abc/ /abc", "abc&gt &gtabc", "lt;", "&gt"]
    rows = local_table(
        spark, [(i, 1, t) for i, t in enumerate(texts)], "entry_id LONG, section_id INT, text STRING"
    )
    for cfg in (CFG, SearchConfig(min_word_length=1, max_word_length=9)):
        tokens = rows.select("entry_id", F.explode(F.array_distinct(F.split("text", " "))).alias("keyword"))
        wanted = tokens.filter((F.col("keyword") != "") & indexing.is_keyword(F.col("keyword"), cfg))
        found = indexing.postings_of(rows, cfg)
        got = {(r["entry_id"], r["keyword"]): (r["frequency"], r["tf"]) for r in found.collect()}
        assert got == {
            (i, k): (texts[i].count(k), texts[i].split(" ").count(k)) for i, k in wanted.collect()
        }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" not in plan


def test_parse_filter():
    assert indexing.parse_filter(r"a, b\,c,, ") == (False, ["a", "b,c"])
    assert indexing.parse_filter("a+ b") == (True, ["a", "b"])


def test_weights(spark):
    df = local_table(spark, [(0,), (1,), (2,), (3,), (4,), (None,)], "w INT")
    assert [r["f"] for r in df.select(weight_factor(F.col("w")).alias("f")).collect()] == [4, 2, 1, 0.5, 0.25, 1]


@pytest.mark.parametrize(
    "typed, adjusted",
    [
        ("countries in the UK", "countries in the United Kingdom"), ("-uk", "-United Kingdom"),
        ("great britain", "great britain"), ("+GB  now", "+United Kingdom  now"), ("", ""),
        ("two", "Aaa"),
    ],
)
def test_synonyms(spark, typed, adjusted):
    synonyms = local_table(
        spark,
        [("United Kingdom", "uk, great britain, GB"), ("Bbb", "two"), ("Aaa", "two")],
        "word STRING, synonyms STRING",
    )
    queries = local_table(spark, [(1, typed)], "qid INT, keywords STRING")
    assert querytext.apply_synonyms(queries, synonyms).first()["adjusted"] == adjusted


@pytest.mark.parametrize(
    "typed, adjusted",
    [
        ("visit Great Britain now", "visit United Kingdom now"),
        ("+great britain -new york city", "+United Kingdom -NYC"),
        ("great -britain", "great -britain"),
        ("new york city hall", "NYC hall"),
        ("new york cit", "Big Apple cit"),
        ("york new york", "york Big Apple"),
        ("a b c d", "ABC d"),
        ("a b x c d", "AB x CD"),
        ("b c a b c", "BC ABC"),
        ("uk", "United Kingdom"),
        ("", ""),
    ],
)
def test_synonyms_of_several_words(spark, typed, adjusted):
    synonyms = local_table(
        spark,
        [
            ("United Kingdom", "uk, great  britain"), ("NYC", "new york city"), ("Big Apple", "new york"),
            ("AB", "a b"), ("BC", "b c"), ("CD", "c d"), ("ABC", "a b c"),
        ],
        "word STRING, synonyms STRING",
    )
    queries = local_table(spark, [(1, typed)], "qid INT, keywords STRING")
    assert querytext.apply_synonyms(queries, synonyms, phrases=True).first()["adjusted"] == adjusted


def test_classify(spark):
    queries = local_table(
        spark,
        [(1, 'foo +bar -baz "a phrase" -"no way" ab'), (2, ""), (3, '"x y" -"x y" + -'), (4, '-"p q" "p q"')],
        "qid INT, adjusted STRING",
    )
    rows = {r["qid"]: r for r in querytext.classify(queries, CFG).collect()}
    assert rows[1]["include_phrase"] == ["a phrase"] and rows[1]["exclude_phrase"] == ["no way"]
    assert rows[1]["include_word"] == ["foo", "bar"] and rows[1]["exclude_word"] == ["baz"]
    assert rows[1]["highlight"] == ["a phrase", "foo", "bar", "ab"]
    assert rows[2]["include_all"] == [] and rows[2]["highlight"] == []
    assert rows[3]["include_phrase"] == ["x y"] and rows[3]["exclude_all"] == []
    assert rows[4]["include_phrase"] == ["p q"] and rows[4]["exclude_phrase"] == ["p q"]


def test_expand_boolean(spark):
    queries = local_table(spark, [(1, 'foo -bar +baz "a b" qux* -"c d"')], "qid INT, keywords STRING")
    assert querytext.expand_boolean(queries, True, True).first()["expanded"] == '+foo* -bar +baz "a b" +qux* -"c d"'
    assert querytext.expand_boolean(queries, False, False).first()["expanded"] == 'foo -bar +baz "a b" qux* -"c d"'


def test_synonym_upsert(spark):
    schema = "word STRING, synonyms STRING"
    synonyms = local_table(spark, [("a", "x"), ("b", "y"), ("c", "z")], schema)
    edits = local_table(spark, [("a", "A", "xx"), (None, "d", "w")], "old_word STRING, word STRING, synonyms STRING")
    deletes = local_table(spark, [("b",)], "word STRING")
    rows = querytext.merge_synonyms(synonyms, edits, deletes).collect()
    assert sorted((r["word"], r["synonyms"]) for r in rows) == [("A", "xx"), ("c", "z"), ("d", "w")]


def test_alternatives(spark):
    dictionary = indexing.with_ids(local_table(spark, [("food",), ("fo",), ("foo",)], "keyword STRING"))
    words = local_table(spark, [("foo",), ("zzz",)], "word STRING")
    rows = suggest.closest_alternative(words, dictionary).collect()
    assert [(r["word"], r["alternative"], r["distance"]) for r in rows] == [("foo", "fo", 1)]


@pytest.mark.parametrize(
    "word, code",
    [
        ("foo", "F000"), ("food", "F300"), ("symphony", "S515"), ("relational", "R4354"), ("Pfister", "P236"),
        ("ashcraft", "A2613"), ("tymczak", "T520"), ("élève", "é410"), ("x", "X000"), ("12ab", "A100"),
        ("123", ""), ("", ""), ("internationalisation", "I5365354235"),
    ],
)
def test_long_soundex(spark, word, code):
    rows = local_table(spark, [(word,)], "word STRING")
    assert rows.select(tx.long_soundex(F.col("word")).alias("c")).first()["c"] == code


def test_rings_give_the_nearest_soundalike(spark):
    draw = random.Random(4)
    stem = ["foo", "mantra", "relational", "bob"]
    known = {"".join(c + draw.choice(["", "a", "e", "oo", "eeee"]) for c in draw.choice(stem)) for _ in range(300)}
    dictionary = stored(indexing.with_ids(local_table(spark, [(w,) for w in sorted(known)], "keyword STRING")), "d")
    words = local_table(spark, [(w,) for w in [*sorted(known)[::3], "foo", "zzz", "mantraaaaaaaaaa"]], "word STRING")
    for code in suggest.CODES:
        every = suggest.soundalikes(words, dictionary, code).collect()
        want = {}
        for r in every:
            want[r["word"]] = min(want.get(r["word"], (99, "")), (r["distance"], r["alternative"]))
        got = suggest.nearest_by_rings(words, dictionary, code).collect()
        assert {r["word"]: (r["distance"], r["alternative"]) for r in got} == want
        assert sum(r["compared"] for r in got) < len(every)


def test_suggestions(spark):
    dictionary = local_table(spark, [("the",), ("then",), ("those",), ("中文字",), ("éa",)], "keyword STRING")
    typed = local_table(spark, [(1, "th"), (2, " The "), (3, "中"), (4, "éa"), (5, "")], "qid INT, keywords STRING")
    rows = suggest.suggest_prefix(typed, dictionary).collect()
    assert sorted((r["qid"], r["keyword"]) for r in rows) == [(2, "the"), (2, "then"), (3, "中文字"), (4, "éa")]
    with pytest.raises(ValueError):
        suggest.suggest_topk(dictionary, CFG, "random")


def test_slug(spark):
    assert one(spark, "--Don't stop!", tx.slug) == "don-t-stop"


def test_log_groups(spark):
    day = lambda d: datetime.datetime(2024, 1, d)
    rows = [
        (3, day(3), "uk", "United Kingdom", "a", 2, 9, "s"),
        (1, day(1), "uk", "United Kingdom", "a", 1, 7, "s"),
        (2, day(2), "uk", "United Kingdom", "a", 3, 8, "s"),
        (4, day(1), "UK ", "uk", "a", 1, 1, "s"),
        (5, day(1), None, None, "a", 1, 2, None),
    ]
    table = spark.createDataFrame(
        rows,
        "id LONG, date TIMESTAMP, keywords STRING, keywords_manipulated STRING, sections STRING, "
        "page INT, results INT, session_id STRING",
    )
    groups = logs.log_groups(table)
    first = groups.filter("keywords = 'uk'").first()
    assert (first["date"], first["results"], first["depth"]) == (day(1), 7, 3)
    adjusted = {r["keywords"]: r["adjusted"] for r in logs.show_adjusted(groups).collect()}
    assert adjusted == {"uk": "United Kingdom", "UK ": None, None: None}
    stats = logs.log_stats(groups).first()
    assert (stats["unique_users"], stats["unique_searches"], stats["unique_terms"], stats["average_results"]) == (1, 3, 2, 3)
    assert logs.filter_logs(table, "K").count() == 4
    with pytest.raises(ValueError):
        logs.log_page(groups, "session_id")


def excerpt_of(spark, text, words, length=250):
    texts = local_table(
        spark, [(1, 1, f" {text} ", words)], "qid INT, entry_id LONG, text STRING, words ARRAY<STRING>"
    )
    return excerpts.excerpts(texts, length).first()["excerpt"]


def test_excerpts(spark):
    plain = ("word " * 80).strip()
    assert excerpt_of(spark, plain, ["none"]) == "<p>" + (f" {plain} ")[:250] + "&#8230;</p>"
    assert excerpt_of(spark, "short & sweet", []) == "<p> short &amp; sweet </p>"
    near = excerpt_of(spark, "x " * 100 + "needle and Pin" + " y" * 100, ["needle", "pin"], 40)
    assert near.count("<strong>") == 2 and near.count("&#8230;") == 2
    far = excerpt_of(spark, "needle " + "x " * 200 + "pin " + "y " * 50, ["needle", "pin"], 40)
    assert far.startswith("<p><strong>needle</strong>") and "&#8230;" in far and "<strong>pin</strong>" in far
    assert "&lt;b&gt;" in excerpt_of(spark, "needle <b> " + "z " * 20, ["needle"])


def test_overlapping_occurrences_are_counted(spark):
    texts = local_table(
        spark, [(1, 1, " banana ananas ", ["ana"])], "qid INT, entry_id LONG, text STRING, words ARRAY<STRING>"
    )
    places = [r["p"] for r in excerpts.occurrences(texts, 10).orderBy("n").collect()]
    assert places == [2, 4, 8, 10]


def test_maintenance(spark):
    schema = "entry_id LONG, section_id INT, keyword STRING"
    rows = local_table(spark, [(1, 1, "own"), (1, 1, "shared"), (2, 2, "shared")], schema)
    left = maintenance.delete_entries(rows, local_table(spark, [(1,)], "entry_id LONG"))
    dictionary = indexing.build_dictionary(rows)
    assert [r["keyword"] for r in maintenance.drop_orphans(dictionary, left).collect()] == ["shared"]
    assert maintenance.delete_section(rows, 1).count() == 1


def test_edit_that_fails_the_filter_keeps_the_old_rows(spark):
    config = [SectionIndex(1, ("text",), filters={"lang": "en"})]
    before = local_table(spark, [(1, 1, "old", "old")], "entry_id LONG, section_id INT, data STRING, data_lc STRING")
    entries = local_table(spark, [(1, 1, "de", "new")], "entry_id LONG, section_id INT, lang STRING, text STRING")
    changes = spark.createDataFrame(
        [(1, datetime.datetime(2024, 1, 1), 1, "edit")], "entry_id LONG, changed_at TIMESTAMP, change_id LONG, op STRING"
    )
    assert maintenance.apply_changes(before, changes, entries, config).first()["data"] == "old"


def test_page_size_falls_back(spark):
    queries = local_table(spark, [(1, None, None, None, 0)], "qid INT, sort STRING, direction STRING, page INT, per_page INT")
    row = ranking.query_settings(queries, CFG).first()
    assert (row["sort"], row["direction"], row["page"], row["per_page"]) == ("score", "desc", 1, 20)


def test_bad_settings():
    for bad in ({"mode": "x"}, {"default_sort": "x"}, {"default_direction": "x"}, {"default_per_page": 0}):
        with pytest.raises(ValueError):
            SearchConfig(**bad)


def test_entities_with_any_number_of_zeros(spark):
    assert one(spark, "&#0000000065;&#x000000000042;&#0;", tx.decode_entities) == "AB&#0;"


def test_missing_keywords_are_an_empty_query(spark):
    queries = local_table(spark, [(1, None), (2, "uk")], "qid INT, keywords STRING")
    synonyms = local_table(spark, [("United Kingdom", "uk")], "word STRING, synonyms STRING")
    out = querytext.apply_synonyms(queries, synonyms).orderBy("qid").collect()
    assert [r["adjusted"] for r in out] == ["", "United Kingdom"]


def test_repeated_phrases_are_one(spark):
    queries = local_table(spark, [(1, '"a b" x "a b" -"c d" -"c d"')], "qid INT, adjusted STRING")
    row = querytext.classify(queries, CFG).first()
    assert row["include_phrase"] == ["a b"] and row["exclude_phrase"] == ["c d"]


def test_sections_as_an_array(spark):
    sections = local_table(
        spark, [(1, "a", "A"), (2, "b", "B")], "section_id INT, handle STRING, name STRING"
    )
    cfg = SearchConfig(default_sections="a,b")
    typed = local_table(
        spark, [(1, ["b", " a"]), (2, []), (3, None), (4, ["c"])], "qid INT, sections ARRAY<STRING>"
    )
    got = querytext.resolve_sections(typed, sections, cfg)
    assert sorted((r["qid"], r["pos"], r["handle"]) for r in got.collect()) == [
        (1, 0, "b"), (1, 1, "a"), (2, 0, "a"), (2, 1, "b"), (3, 0, "a"), (3, 1, "b"),
    ]


FULL_TEXTS = [
    (1, 1, "foo or what is it here"), (2, 1, "foo is not it"), (3, 1, "x=y foo bar"),
    (4, 1, "foo x=y bar"), (5, 2, "foo is it"),
]


@pytest.mark.parametrize(
    "typed, entries",
    [
        ('+"is it" foo', [1]),
        ('"is it"', [1]),
        ('"x=y foo"', [3]),
        ('-"is it" foo', [2, 3, 4]),
        ('+"is it" +"x=y foo"', []),
        ("+is foo", [1, 2, 3, 4]),
    ],
)
def test_full_text_phrases_of_any_words(spark, typed, entries):
    index = local_table(
        spark, [(*row, row[2]) for row in FULL_TEXTS], "entry_id LONG, section_id INT, data STRING, data_lc STRING"
    )
    postings = indexing.build_postings(index, CFG)
    terms = matching.boolean_terms(local_table(spark, [(1, typed)], "qid INT, adjusted STRING"), CFG)
    resolved = local_table(spark, [(1, 1)], "qid INT, section_id INT")
    hits = matching.match_fulltext(
        postings, indexing.build_dictionary(postings), indexing.build_positions(index), terms, resolved
    )
    assert sorted(r["entry_id"] for r in hits.collect()) == entries


def test_a_token_of_a_million_characters(spark):
    text = "ab " + "xab" * 350_000
    index = spark.createDataFrame([(1, 1, text, text)], "entry_id LONG, section_id INT, data STRING, data_lc STRING")
    words = spark.createDataFrame([(2, 1, "xab abx " + text, "")], index.schema)
    rows = indexing.build_postings(index.unionByName(words), SearchConfig(min_word_length=2)).collect()
    found = {(r["entry_id"], r["keyword"]): (r["frequency"], r["tf"]) for r in rows}
    assert found[1, "ab"] == (350_001, 1)
    assert found[2, "xab"] == (350_001, 1)
    assert found[2, "abx"] == (350_000, 1)


def test_log_ids_follow_the_log(spark):
    from wordloom.sources.logs import run_rows

    adjusted = local_table(spark, [(1, "a", "a"), (2, "b", "b")], "qid INT, keywords STRING, adjusted STRING")
    resolved = local_table(spark, [(1, 0, "s"), (2, 0, "s")], "qid INT, pos INT, handle STRING")
    totals = local_table(spark, [(1, 5, 1), (2, 0, 1)], "qid INT, total LONG, page INT")
    out = run_rows(adjusted, resolved, totals, F.current_timestamp(), F.lit("s"), F.lit(1000))
    assert sorted(r["id"] for r in out.collect()) == [1001, 1002]


def test_positions_find_phrases_without_a_text(spark):
    texts = [(1, "The cat, the cat sat; on the mat."), (2, "cat the on"), (3, "a b a b a c"), (4, "")]
    index = local_table(spark, [(i, 1, t) for i, t in texts], "entry_id LONG, section_id INT, data STRING")
    positions = stored(indexing.build_positions(index), "positions")
    rows = {(r["entry_id"], r["token"]): r["places"] for r in positions.collect()}
    assert rows[1, "the"] == [0, 2, 6] and rows[3, "a"] == [0, 2, 4] and (4, "") not in rows
    phrases = ["the cat", "cat the cat", "the cat the", "the on", "a b a c", "b b", "a c a", "none here", "the the"]
    asked = local_table(spark, [(p,) for p in phrases], "phrase STRING")
    hits = matching.phrase_hits(positions, asked)
    assert sorted((r["phrase"], r["entry_id"]) for r in hits.collect()) == [
        ("a b a c", 3), ("cat the cat", 1), ("the cat", 1), ("the cat the", 1), ("the on", 2),
    ]
    assert "data#" not in hits._jdf.queryExecution().optimizedPlan().toString()


def ranking_tables(spark, seed):
    draw = random.Random(seed)
    rows = []
    for entry in range(600):
        words = {"stop": draw.randrange(1, 4), f"mid{draw.randrange(6)}": 1}
        if draw.random() < 0.05:
            words[f"rare{draw.randrange(4)}"] = draw.randrange(1, 6)
        rows += [(entry, entry % 3, w, n, n) for w, n in words.items()]
    schema = "entry_id LONG, section_id INT, keyword STRING, frequency INT, tf INT"
    postings = stored(local_table(spark, rows, schema), "postings")
    asked = ["stop", "stop rare1", "stop mid2 rare0 rare3", "mid1 mid2", "rare2", "nothing", "stop mid0 -rare1"]
    queries = [(q, text) for q, text in enumerate(asked)]
    terms = matching.boolean_terms(local_table(spark, queries, "qid INT, adjusted STRING"), CFG)
    scope = [(q, s) for q in range(len(asked)) for s in range(3) if q != 4 or s == 1]
    return postings, indexing.build_dictionary(postings), terms, local_table(spark, scope, "qid INT, section_id INT")


@pytest.mark.parametrize("k", [1, 5, 10_000])
def test_bounded_top_equals_the_whole_ranking(spark, k):
    tables = ranking_tables(spark, 2)
    every = {}
    for r in matching.fulltext_relevance(*tables).collect():
        every.setdefault(r["qid"], []).append((-r["relevance"], r["entry_id"]))
    want = {(q, i + 1, e, -v) for q, rows in every.items() for i, (v, e) in enumerate(sorted(rows)[:k])}
    impacts = topk.build_impacts(tables[0], k)
    got = topk.fulltext_top(impacts, *tables[1:], k).collect()
    assert {(r["qid"], r["rank"], r["entry_id"], r["relevance"]) for r in got} == want and len(got) == len(want)


def test_common_words_beside_rare_ones_are_not_looked_through(spark):
    postings, dictionary, terms, resolved = ranking_tables(spark, 2)
    impacts = topk.build_impacts(postings, 3)
    words = matching.query_keywords(terms.filter("sign <> '-'"), dictionary).select("qid", "keyword").distinct()
    bounded = topk.bounded_words(impacts, words, resolved, 3)
    left_out = {(r["qid"], r["keyword"]) for r in bounded.filter("need > bound").collect()}
    assert {(1, "stop"), (2, "stop")} <= left_out and (0, "stop") not in left_out
    met = topk.candidates(impacts, stored(bounded, "bounded"), resolved, 3).groupBy("qid").count()
    assert {r["qid"]: r["count"] for r in met.collect()}[1] < 60


@pytest.mark.parametrize("method", ["scan", "tokens"])
def test_accents_can_be_left_out_of_account(spark, method):
    texts = ["Élève", "eleve", "ÉLÈVE élève", "cafe\u0301", "straße"]
    index = local_table(
        spark, [(i, 1, t, t.lower()) for i, t in enumerate(texts)],
        "entry_id LONG, section_id INT, data STRING, data_lc STRING",
    )
    terms = [(1, "élève", False), (2, "eleve", False), (3, "café", False), (4, "strasse", False), (5, "élève", True)]
    terms = local_table(spark, terms, "qid INT, term STRING, excluded BOOLEAN")
    scope = local_table(spark, [(q, 1) for q in range(1, 6)], "qid INT, section_id INT")
    cfg = SearchConfig(method=method, fold_accents=True)
    got = matching.match_terms(index, terms, scope, cfg).collect()
    assert sorted((r["qid"], r["entry_id"], int(r["occurrences"])) for r in got) == [
        (1, 0, 1), (1, 1, 1), (1, 2, 2), (2, 0, 1), (2, 1, 1), (2, 2, 2), (3, 3, 1), (5, 3, 1), (5, 4, 1),
    ]
    got = matching.match_terms(index, terms, scope, SearchConfig(method=method)).collect()
    assert sorted((r["qid"], r["entry_id"]) for r in got if r["qid"] < 4) == [(1, 0), (1, 2), (2, 1)]


def test_pieces_grow_with_changes(spark):
    tokens = lambda *words: local_table(spark, [(w,) for w in words], "token STRING")
    old = matching.build_pieces(tokens("abc", "ab"))
    grown = old.unionByName(matching.fresh_pieces(old, tokens("ab", "xabc", "é")))
    whole = matching.build_pieces(tokens("abc", "ab", "xabc", "é"))
    as_rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert as_rows(grown) == as_rows(whole)


@pytest.mark.parametrize("sort", completions.SORTS)
@pytest.mark.parametrize("limit", [1, 2, 5])
def test_completion_lists_give_what_counting_gives(spark, sort, limit):
    """Many ties, keywords that are first only in the sum of sections, and lists that don't settle it."""
    made = random.Random(limit)
    letters = [a + b + c for a in "ab" for b in "ab" for c in "abé中"]
    totals = local_table(
        spark,
        [(w, s, made.randint(1, 4), 1) for w in letters + ["a", "b'c"] for s in (1, 2, 3) if made.random() < 0.8],
        "keyword STRING, section_id INT, frequency LONG, entries LONG",
    )
    typed = local_table(
        spark, [(i, w) for i, w in enumerate(["aaa", " aB中", "ab", "a", None, "", "bbbb", "aaé", "b'c"])], "qid INT, keywords STRING"
    )
    resolved = local_table(spark, [(0, 1), (1, 1), (1, 2), (1, 2), (7, 3)], "qid INT, section_id INT")
    cfg = SearchConfig(suggest_limit=limit)
    lists = stored(completions.build_completions(totals, limit), "lists")
    counted = suggest.suggest_frequency(suggest.suggest_prefix(typed, totals.select("keyword").distinct()), totals, resolved)
    columns = ("qid", "rank", "keyword", "frequency", "handle")
    as_rows = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    want = as_rows(suggest.suggest_topk(counted, cfg, sort))
    assert want and as_rows(completions.complete(typed, lists, totals, resolved, cfg, sort)) == want
    # Short beginnings, which a query can't ask for, show that sums are met by the exact way.
    short = completions.asked_sections(typed, resolved).limit(0).unionByName(
        local_table(spark, [(i, w, None) for i, w in enumerate(["a", "b", "ab", "ba"])], "qid INT, typed STRING, section_id INT")
    )
    found = completions.look_up(short, lists, totals, limit, limit, sort).collect()
    whole = {}
    for r in totals.collect():
        for i, w in enumerate(["a", "b", "ab", "ba"]):
            if r["keyword"].startswith(w):
                whole.setdefault(i, {}).setdefault(r["keyword"], 0)
                whole[i][r["keyword"]] += r["frequency"]
    for i, sums in whole.items():
        order = sorted(sums.items(), key=lambda x: x[0] if sort == "alphabetical" else (-x[1], x[0]))[:limit]
        rows_ = sorted((r["rank"], r["keyword"], r["frequency"]) for r in found if r["qid"] == i and r["sure"])
        assert not rows_ or [r[1:] for r in rows_] == order
    with pytest.raises(ValueError):
        completions.complete(typed, lists, totals, resolved, cfg, sort, depth=limit - 1 or -1)


def test_suggestions_are_found_once(spark):
    """Limited and unlimited queries, sections given twice, null sections, and a sign that gets shorter in lower case."""
    totals = local_table(
        spark,
        [("abc", 1, 2, 1), ("abc", 2, 3, 1), ("abc", None, 7, 1), ("abcd", 2, 5, 1), ("k", 1, 1, 1), ("", 1, 9, 1), (None, 1, 9, 1)],
        "keyword STRING, section_id INT, frequency LONG, entries LONG",
    )
    asked = [(1, "abc"), (2, " ABC"), (3, "abcd"), (4, "abc"), (5, "ab"), (6, "\u212a"), (7, None), (None, "abcd")]
    typed = local_table(spark, asked, "qid INT, keywords STRING")
    resolved = local_table(spark, [(1, 1), (1, 1), (1, 2), (3, 1), (4, None), (None, 1)], "qid INT, section_id INT")
    counted = suggest.suggest_frequency(suggest.suggest_prefix(typed, totals.select("keyword").distinct()), totals, resolved)
    assert {(r["qid"], r["keyword"], r["frequency"]) for r in counted.collect()} == {
        (1, "abc", 5), (1, "abcd", 5), (2, "abc", 12), (2, "abcd", 5), (6, "k", 1), (None, "abcd", 5),
    }
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1


def test_spans_of_days_against_distinct_counts(spark, tmp_path):
    """Every span of days; nulls, a batch met twice and a late one change what they should."""
    day = lambda d, h: datetime.datetime(2024, 1, d, h) if d else None
    made = random.Random(5)
    log = [
        (day(made.choice([1, 2, 4, 5, 0]), made.randint(0, 23)), made.choice(["a", "b", "ab", "", None]), made.choice(["s", "t", "u", None]))
        for _ in range(60)
    ]
    path = str(tmp_path / "days")
    for part in (log[:20], log[20:], log[:20]):
        log_feed.fold_log_days(spark.createDataFrame(part, "date TIMESTAMP, keywords STRING, session_id STRING"), path)
    days = log_feed.stored_log_days(spark, path)
    assert days.count() == days.select("kind", "block", "day").distinct().count()
    numbers = spark.read.parquet(path + "/numbers")
    assert numbers.count() == numbers.select("kind", "value").distinct().count() == numbers.select("kind", "number").distinct().count()
    spans_ = [(datetime.date(2024, 1, a), datetime.date(2024, 1, b)) for a in range(1, 7) for b in range(1, 7)]
    asked = spark.createDataFrame(spans_ + spans_[:1], "first_day DATE, last_day DATE")
    for got in spans.count_spans(asked, days).collect():
        inside = [r[1:] for r in log if r[0] and got["first_day"] <= r[0].date() <= got["last_day"]]
        want = (len({s for _, s in inside} - {None}), len(set(inside)), len({k for k, _ in inside} - {None}))
        assert (got["unique_users"], got["unique_searches"], got["unique_terms"]) == want
        spans_.remove((got["first_day"], got["last_day"]))
    assert not spans_


def test_numbers_fill_more_than_one_block(spark):
    values = spark.range(100_000).select(F.lit("term").alias("kind"), F.col("id").cast("string").alias("value"))
    none = spark.createDataFrame([], spans.NUMBERS_SCHEMA)
    numbers = stored(spans.new_numbers(values, none, 2), "numbers")
    days = spans.day_bitmaps(values.withColumn("day", F.lit("2024-01-01").cast("date")), numbers)
    asked = spark.sql("SELECT DATE '2024-01-01' AS first_day, DATE '2024-01-02' AS last_day")
    assert days.count() == 4
    assert spans.count_spans(asked, days).first()["unique_terms"] == 100_000


@pytest.mark.parametrize("method", ["tokens", "scan"])
def test_queries_of_many_terms_and_repeated_ones(spark, method, monkeypatch):
    """Terms are counted as bits, queries of a word in parts, settings go with the hits."""
    monkeypatch.setattr(matching, "TOGETHER", 2)
    texts = [" ".join(f"w{i:03}x" for i in range(130)), " ".join(f"w{i:03}x" for i in range(129)), "w000x w001x w000x"]
    rows = [(i, 1 + i % 2, t, t) for i, t in enumerate(texts)]
    index = spark.createDataFrame(rows, "entry_id LONG, section_id INT, data STRING, data_lc STRING")
    every = [(1, f"w{i:03}x", False) for i in range(130)]
    rows = every + [(q, "w000", False) for q in range(2, 8)] + [(8, "w000x", False), (8, "w000x", False)]
    rows += [(9, "w128x", True), (10, "w000x", False), (10, "w129x", True), (11, "nosuch", False)]
    terms = spark.createDataFrame(rows, "qid INT, term STRING, excluded BOOLEAN")
    scope = spark.createDataFrame([(q, s) for q in range(1, 12) for s in (1, 2) if (q, s) != (7, 1)], "qid INT, section_id INT")
    settings = spark.createDataFrame([(q, "score" if q < 5 else "id") for q in range(1, 12)] + [(2, "date")], "qid INT, sort STRING")
    got = matching.match_terms(index, terms, scope, SearchConfig(method=method), settings=settings).collect()
    want = [(1, 0, 130, 130, "score")]
    want += [(q, e, 1, 1 + (e == 2), s) for q in range(2, 7) for e in range(3) for s in (["score", "date"] if q == 2 else ["score"] if q < 5 else ["id"])]
    want += [(7, 1, 1, 1, "id")] + [(8, e, 2, 2 + 2 * (e == 2), "id") for e in range(3)]
    want += [(9, 2, 1, 1, "id"), (10, 1, 1, 1, "id"), (10, 2, 1, 2, "id")]
    found = [(r["qid"], r["entry_id"], r["keywords_matched"], int(r["occurrences"]), r["sort"]) for r in got]
    assert sorted(found) == sorted(want)


def test_texts_that_come_twice_count_as_two_hits_of_a_text_and_one_of_tokens(spark):
    texts = [(1, 1, "ab cd"), (1, 1, "ab cd"), (2, 1, "ab cd")]
    index = spark.createDataFrame([(*r, r[2]) for r in texts], "entry_id LONG, section_id INT, data STRING, data_lc STRING")
    terms = spark.createDataFrame([(1, "ab", False), (2, "ab cd", False)], "qid INT, term STRING, excluded BOOLEAN")
    scope = spark.createDataFrame([(1, 1), (2, 1)], "qid INT, section_id INT")

    def found(cfg):
        rows = matching.match_terms(index, terms, scope, cfg).collect()
        return sorted((r["qid"], r["entry_id"], int(r["occurrences"])) for r in rows)

    assert found(SearchConfig(method="scan")) == [(1, 2, 1), (2, 2, 1)]
    assert found(SearchConfig(method="tokens")) == [(1, 1, 2), (1, 2, 1), (2, 2, 1)]
    assert found(SearchConfig(method="scan", match_stems=True)) == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 2, 1)]
