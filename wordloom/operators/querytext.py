"""Query text: synonyms, boolean classification, sections — over a table of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.config import SearchConfig
from wordloom.functions import text as tx
from wordloom.functions.stem import stem_vocabulary
from wordloom.session import stored

PHRASE = r'(-?)"([^"]+)"'
# A blank-separated token in which quoted parts may hold blanks.
QUOTED_TOKEN = r'(?:"[^"]*"|[^ ])+'


def explode_synonyms(synonyms: DataFrame) -> DataFrame:
    """``(term, word)``: every lower-cased synonym with its replacement."""
    term = F.explode(F.split("synonyms", ","))
    return (
        synonyms.select("word", term.alias("term"))
        .select(F.lower(tx.trimmed(F.col("term"))).alias("term"), "word")
        .filter(F.col("term") != "")
    )


def merge_synonyms(synonyms: DataFrame, edits: DataFrame, deletes: DataFrame) -> DataFrame:
    """Apply edits ``(old_word, word, synonyms)`` and deletes ``(word)``.

    Rows are keyed by the SHA-1 of their word; an edit replaces the row of its old word and
    of its new one.
    """
    key = F.sha1("word")
    gone = (
        edits.select(F.sha1("old_word").alias("hash"))
        .unionByName(edits.select(key.alias("hash")))
        .unionByName(deletes.select(key.alias("hash")))
        .filter(F.col("hash").isNotNull())
        .distinct()
    )
    kept = synonyms.select(key.alias("hash"), "word", "synonyms").join(gone, "hash", "left_anti")
    return kept.unionByName(edits.select(key.alias("hash"), "word", "synonyms"))


def signed_words(queries: DataFrame) -> DataFrame:
    """``(qid, pos, sign, term)``: the words of each query, lower-cased."""
    keywords = F.coalesce("keywords", F.lit(""))
    return queries.select(
        "qid", F.posexplode(F.split(tx.trimmed(keywords), " ")).alias("pos", "raw")
    ).select(
        "qid",
        "pos",
        F.regexp_extract("raw", "^[+-]", 0).alias("sign"),
        F.lower(tx.trimmed(F.regexp_replace("raw", "^[+-]", ""))).alias("term"),
    )


def rejoined(queries: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``adjusted``: the texts of ``(qid, item(pos, text))`` in order."""
    ordered = F.sort_array(F.collect_list("item"))
    adjusted = items.groupBy("qid").agg(
        tx.trimmed(F.array_join(F.transform(ordered, lambda i: i["text"]), " ")).alias("adjusted")
    )
    return queries.join(adjusted, "qid")


def apply_synonyms(queries: DataFrame, synonyms: DataFrame, phrases: bool = False) -> DataFrame:
    """Add ``adjusted``: words equal to a synonym replaced, a leading + or - kept.

    Where a term belongs to several replacements the first one in word order is used. Missing
    keywords count as empty. With ``phrases`` synonyms of several words are found too: from left to
    right, the longest one that starts at a word is taken and the search goes on behind it. A sign
    within one prevents it, one before it is kept.
    """
    lookup = explode_synonyms(synonyms).groupBy("term").agg(F.min("word").alias("word"))
    words = signed_words(queries)
    if phrases:
        return rejoined(queries, segmented(words, stored(lookup, "synonym-terms")))
    replaced = words.join(lookup, "term", "left").select(
        "qid",
        F.struct("pos", F.concat("sign", F.coalesce("word", "term")).alias("text")).alias("item"),
    )
    return rejoined(queries, replaced)


def segmented(words: DataFrame, lookup: DataFrame) -> DataFrame:
    """``(qid, item)`` with the longest synonyms from left to right replaced.

    The runs of words that are as long as some synonym meet the synonyms in an equi-join; one pass
    over the matches of a query, by place and falling length, then takes those that start at or
    behind the end of the one before.
    """
    size = F.size(F.split("term", " +"))
    lookup = lookup.select(F.regexp_replace("term", " +", " ").alias("term"), "word", size.alias("size"))
    lookup = lookup.groupBy("term", "size").agg(F.min("word").alias("word"))
    # As many numbers as there are different lengths of a synonym.
    sizes = lookup.agg(F.array_sort(F.collect_set("size")).alias("sizes")).scalar()
    item = F.struct("pos", "sign", "term")
    queries = stored(
        words.groupBy("qid").agg(F.sort_array(F.collect_list(item)).alias("words")), "query-words"
    )
    runs = queries.select(
        "qid", "words", F.posexplode("words").alias("at", "start"), sizes.alias("sizes")
    ).select("qid", "at", "words", F.explode("sizes").alias("size"))
    run = F.slice("words", F.col("at") + 1, F.col("size"))
    runs = runs.filter(F.col("at") + F.col("size") <= F.size("words")).select("qid", "at", "size", run.alias("run"))
    unsigned = F.forall(F.slice("run", 2, F.greatest(F.size("run") - 1, F.lit(0))), lambda w: w["sign"] == "")
    term = F.array_join(F.transform("run", lambda w: w["term"]), " ")
    matches = runs.filter(unsigned).select("qid", "at", "size", term.alias("term")).join(lookup, ["term", "size"])
    order = F.struct("at", (-F.col("size")).alias("shorter"), "size", "word")
    found = matches.groupBy("qid").agg(F.sort_array(F.collect_list(order)).alias("found"))
    nothing = F.array().cast("array<struct<at:int,size:int,word:string>>")
    taken = F.aggregate(
        F.coalesce("found", F.array().cast("array<struct<at:int,shorter:int,size:int,word:string>>")),
        F.struct(F.lit(0).alias("end"), nothing.alias("taken")),
        lambda state, m: F.when(
            m["at"] >= state["end"],
            F.struct(
                (m["at"] + m["size"]).alias("end"),
                F.concat(state["taken"], F.array(F.struct(m["at"], m["size"], m["word"]))).alias("taken"),
            ),
        ).otherwise(state),
        lambda state: state["taken"],
    )
    rows = queries.join(found, "qid", "left").select("qid", "words", taken.alias("taken"))
    one = rows.select("qid", "taken", F.posexplode("words").alias("at", "w"))
    over = F.filter("taken", lambda t: (t["at"] <= F.col("at")) & (F.col("at") < t["at"] + t["size"]))
    one = one.select("qid", "at", "w", F.get(over, F.lit(0)).alias("by"))
    kept = one.filter(F.col("by").isNull() | (F.col("by.at") == F.col("at")))
    text = F.concat("w.sign", F.coalesce("by.word", "w.term")).alias("text")
    return kept.select("qid", F.struct(F.col("at").alias("pos"), text).alias("item"))


def clean_words(words: Column) -> Column:
    return F.filter(words, lambda w: w != "")


def classify(
    queries: DataFrame, cfg: SearchConfig, column: str = "adjusted"
) -> DataFrame:
    """Add the seven keyword lists of each query.

    ``include_phrase``, ``exclude_phrase``, ``include_word``, ``exclude_word``,
    ``include_all``, ``exclude_all`` and ``highlight`` (the words to mark in excerpts).
    Only included words pass the length test.
    """
    text = F.col(column)
    # The first match of a phrase stands for all its copies.
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(PHRASE), F.lit(0)))
    df = queries.withColumn("found", found)

    def taken_before(match: Column, at: Column) -> Column:
        # An excluded phrase that already stood included earlier counts as included only.
        earlier = F.slice(F.col("found"), F.lit(1), at)
        return F.array_contains(earlier, F.regexp_replace(match, "^-", ""))

    included = F.filter(F.col("found"), lambda m: ~F.startswith(m, F.lit("-")))
    excluded = F.filter(
        F.col("found"), lambda m, at: F.startswith(m, F.lit("-")) & ~taken_before(m, at)
    )
    bare = lambda m: F.regexp_replace(m, '^-?"|"$', "")
    rest = F.lower(F.regexp_replace(F.regexp_replace(text, PHRASE, ""), " +", " "))
    df = df.select(
        *queries.columns,
        F.transform(included, bare).alias("include_phrase"),
        F.transform(excluded, bare).alias("exclude_phrase"),
        F.split(tx.trimmed(rest), " ").alias("words"),
    )
    positive = F.filter("words", lambda w: ~F.startswith(w, F.lit("-")))
    positive = clean_words(F.transform(positive, lambda w: F.regexp_replace(w, r"^\+", "")))
    negative = F.filter("words", lambda w: F.startswith(w, F.lit("-")))
    negative = clean_words(F.transform(negative, lambda w: F.regexp_replace(w, "^-", "")))
    df = df.withColumn("positive", positive).withColumn("exclude_word", negative)
    size_ok = lambda w: F.char_length(w).between(
        cfg.min_word_length, cfg.max_word_length - 1
    )
    df = df.withColumn("include_word", F.filter("positive", size_ok))
    return df.select(
        *queries.columns,
        "include_phrase",
        "exclude_phrase",
        "include_word",
        "exclude_word",
        F.array_distinct(F.concat("include_phrase", "include_word")).alias("include_all"),
        F.array_distinct(F.concat("exclude_phrase", "exclude_word")).alias("exclude_all"),
        F.array_distinct(F.concat("include_phrase", "positive")).alias("highlight"),
    )


def highlight_stems(parsed: DataFrame) -> DataFrame:
    """Add each highlighted word's stem behind it (phrases have none)."""
    items = parsed.select("qid", "include_phrase", F.posexplode("highlight").alias("pos", "keyword"))
    stems = stem_vocabulary(items.select("keyword").distinct())
    is_phrase = F.array_contains("include_phrase", F.col("keyword"))
    pair = F.when(is_phrase, F.array("keyword")).otherwise(F.array("keyword", "stem"))
    rows = items.join(stems, "keyword").groupBy("qid").agg(
        F.sort_array(F.collect_list(F.struct("pos", pair.alias("pair")))).alias("pairs")
    )
    merged = F.array_distinct(F.flatten(F.transform("pairs", lambda p: p["pair"])))
    rows = rows.select("qid", merged.alias("with_stems"))
    return (
        parsed.join(rows, "qid", "left")
        .withColumn("highlight", F.coalesce("with_stems", "highlight"))
        .drop("with_stems")
    )


def keyword_classes(parsed: DataFrame) -> DataFrame:
    """The seven lists as ``(qid, class, word)`` rows."""
    names = (
        "include_phrase", "exclude_phrase", "include_word", "exclude_word",
        "include_all", "exclude_all", "highlight",
    )
    lists = F.create_map(*[c for n in names for c in (F.lit(n), F.col(n))])
    return parsed.select("qid", F.explode(lists).alias("class", "words")).select(
        "qid", "class", F.explode("words").alias("word")
    )


def query_terms(parsed: DataFrame) -> DataFrame:
    """``(qid, term, excluded)``: what must and must not occur, lower-cased."""
    side = lambda words, flag: F.transform(
        F.array_distinct(F.transform(words, F.lower)),
        lambda w: F.struct(w.alias("term"), F.lit(flag).alias("excluded")),
    )
    both = F.concat(side(F.col("include_all"), False), side(F.col("exclude_all"), True))
    return parsed.select("qid", F.inline(both)).filter(
        tx.trimmed(F.col("term")) != ""
    )


def expand_boolean(queries: DataFrame, require_all: bool, wildcard: bool) -> DataFrame:
    """Add ``expanded``: unsigned, unquoted words get a leading + and a trailing *."""
    words = F.regexp_extract_all(tx.trimmed(F.col("keywords")), F.lit(QUOTED_TOKEN), F.lit(0))

    def mark(word: Column) -> Column:
        plain = ~F.rlike(word, F.lit('^[-+"]'))
        prefix = F.lit("+" if require_all else "")
        star = F.when(F.endswith(word, F.lit("*")), "").otherwise("*" if wildcard else "")
        return F.when(plain, F.concat(prefix, word, star)).otherwise(word)

    return queries.withColumn("expanded", F.array_join(F.transform(words, mark), " "))


def resolve_sections(queries: DataFrame, sections: DataFrame, cfg: SearchConfig) -> DataFrame:
    """``(qid, section_id, handle, name, pos)`` of each query's known sections.

    ``sections`` is text with commas or an array of handles. An empty list falls back to the
    default one; unknown handles drop out.
    """
    given = F.col("sections")
    if not isinstance(queries.schema["sections"].dataType, T.ArrayType):
        given = F.when(given != "", F.split(given, ","))
    wanted = F.when(F.size(F.coalesce(given, F.array())) > 0, given).otherwise(
        F.split(F.lit(cfg.default_sections), ",")
    )
    handles = queries.select("qid", F.posexplode(wanted).alias("pos", "handle"))
    return (
        handles.withColumn("handle", tx.trimmed(F.col("handle")))
        .groupBy("qid", "handle")
        .agg(F.min("pos").alias("pos"))
        .join(sections, "handle")
        .select("qid", "section_id", "handle", "name", "pos")
    )


def section_errors(queries: DataFrame, resolved: DataFrame) -> DataFrame:
    """Queries left without any valid section, with the message they get."""
    return queries.select("qid").join(resolved, "qid", "left_anti").withColumn(
        "error", F.lit("Invalid search sections")
    )
