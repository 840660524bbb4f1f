"""Which entries match which queries.

Every mode first finds *term hits*: ``(term, entry, n)`` rows saying how often a word or
phrase occurs in an entry. The caller says how: ``method="scan"`` tests all terms on every text
in one pass, for batches of few terms; ``method="tokens"`` matches the terms against the
vocabulary and reaches the entries by an equi-join on tokens, for any number. Both ways give the
same rows. One aggregation by (query, entry) then applies the boolean rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.config import SearchConfig, check_choice
from wordloom.functions import text as tx
from wordloom.functions.products import block_scores
from wordloom.functions.scoring import bm25
from wordloom.functions.stem import stem_vocabulary
from wordloom.operators.indexing import (
    build_token_index,
    is_keyword,
    keyword_totals,
    length_gate,
)
from wordloom.session import joinable, stored

ENTRY = ["entry_id", "section_id"]


def join_entries(index: DataFrame, dates: DataFrame) -> DataFrame:
    """Index text and section with the creation date of its entry.

    Where the dates are many this moves the texts by entry id; searches join dates to hits.
    """
    text = index.select("entry_id", "section_id", "data", "data_lc")
    return text.join(dates.select("entry_id", "creation_date"), "entry_id")


def in_sections(index: DataFrame, resolved: DataFrame) -> DataFrame:
    """Entries in any section some query asks for, however many those are.

    The distinct ids are a table of at most one row per section; below Spark's own threshold it
    is broadcast and prunes the partitions of a stored index, so the texts stay in place.
    """
    ids = resolved.select("section_id").filter("section_id IS NOT NULL").distinct()
    return index.join(ids, "section_id", "left_semi").select(*index.columns)


def numbered(lists: DataFrame, number: str) -> tuple[DataFrame, DataFrame]:
    """``(qid, number)`` and ``(number, list)`` for rows of queries and lists: equal lists share a number."""
    lists = stored(lists, "lists")
    named = stored(lists.select("list").distinct().withColumn(number, F.monotonically_increasing_id()), "numbered")
    return stored(lists.join(joinable(named), "list").select("qid", number), "numbers"), named


def scoped(rows: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of queries with the ``scope`` of each, and the sections of the scopes.

    Queries that ask for the same sections share a scope, which is a number. So hits meet a table of
    few rows and not one of all queries times their sections. Queries without a section fall out.
    """
    sections = F.array_sort(F.collect_set("section_id")).alias("list")
    members, named = numbered(resolved.filter("section_id IS NOT NULL").groupBy("qid").agg(sections), "scope")
    return rows.join(joinable(members), "qid"), named.select("scope", F.explode("list").alias("section_id"))


def scan_hits(index: DataFrame, terms: DataFrame, whole: bool) -> DataFrame:
    """Term hits by one pass over the texts: no join, no shuffle of texts.

    All terms are one array in every task, so this way is for batches of few terms.
    """
    text = F.col("data_lc")
    listed = terms.agg(F.array_sort(F.collect_set("term")).alias("terms")).scalar()
    rows = index.select(*ENTRY, "data_lc", listed.alias("terms"))
    found = F.filter("terms", lambda t: F.contains(text, t))
    hit = lambda t: F.struct(
        t.alias("term"),
        tx.count_substring(text, t).alias("n"),
        (tx.has_whole_word(text, t) if whole else F.lit(True)).alias("ok"),
    )
    return rows.select(*ENTRY, F.inline(F.transform(found, hit)))


def grams(word: Column, size: int) -> Column:
    return F.regexp_extract_all(word, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def build_pieces(tokens: DataFrame) -> DataFrame:
    """``(gram, token)``: each distinct token under its pieces of one to three letters.

    Kept with the index, so that a batch of words reads neither texts nor the whole vocabulary.
    """
    pieces = F.array_distinct(F.concat(*[grams(F.col("token"), s) for s in (1, 2, 3)]))
    return tokens.select("token").distinct().select(F.explode(pieces).alias("gram"), "token")


def fresh_pieces(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """The pieces of those tokens that the stored ones don't have yet, to be added to them."""
    known = pieces.filter(F.col("gram") == F.left("token", F.lit(1))).select("token").distinct()
    return build_pieces(tokens.select("token").distinct().join(known, "token", "left_anti"))


def vocabulary_matches(pieces: DataFrame, terms: DataFrame, whole: bool) -> DataFrame:
    """``(term, token, n, ok)`` for tokens that contain a term.

    A term can only lie in tokens that hold its rarest three-letter piece, so the pairs to
    verify come from an equi-join on that piece, over words only.
    """
    size = F.least(F.lit(3), F.char_length("term"))
    term_grams = terms.select(
        "term",
        F.explode(
            F.when(size == 3, grams(F.col("term"), 3)).when(size == 2, grams(F.col("term"), 2))
            .otherwise(F.array("term"))
        ).alias("gram"),
    ).distinct()
    # Only pieces that some term has; one and two letters play a part for short terms alone.
    by_gram = pieces.join(term_grams.select("gram").distinct(), "gram", "left_semi")
    gram_count = by_gram.groupBy("gram").agg(F.count(F.lit(1)).alias("tokens"))
    anchors = (
        term_grams.join(gram_count, "gram")
        .groupBy("term")
        .agg(F.min(F.struct("tokens", "gram")).alias("rarest"))
        .select("term", F.col("rarest.gram").alias("gram"))
    )
    pairs = anchors.join(by_gram, "gram").filter(F.contains(F.col("token"), F.col("term")))
    ok = tx.has_whole_word(F.col("token"), F.col("term")) if whole else F.lit(True)
    return pairs.select(
        "term",
        "token",
        tx.count_substring(F.col("token"), F.col("term")).alias("n"),
        ok.alias("ok"),
    )


def phrase_text_hits(
    index: DataFrame, tokens: DataFrame, phrases: DataFrame, pieces: DataFrame, whole: bool
) -> DataFrame:
    """Hits of terms with blanks: ``(entry_id, section_id, term, n, ok)``, verified on the candidate texts."""
    # A phrase of three words or more holds a whole token between its blanks; its rarest one
    # picks the candidates. Shorter phrases use their longest word as a part of a token.
    parts = F.split("term", r"\s+")
    inner = phrases.select("term", F.explode(F.slice(parts, 2, F.size(parts) - 2)).alias("token"))
    inner = stored(inner, "inner-words")
    token_count = tokens.join(joinable(inner.select("token").distinct()), "token", "left_semi").groupBy(
        "token"
    ).agg(F.count(F.lit(1)).alias("rows"))
    rarest = (
        inner.join(token_count, "token", "left")
        .groupBy("term")
        .agg(F.min(F.struct(F.coalesce("rows", F.lit(0)), "token")).alias("pick"))
        .select("term", F.col("pick.token").alias("token"))
    )
    # Of a known size, so that few phrases don't move all tokens.
    rarest = joinable(stored(rarest, "rarest-words"))
    long_candidates = tokens.join(rarest, "token").select("entry_id", "term")
    two = phrases.filter(F.size(parts) == 2).select(
        F.col("term").alias("phrase"),
        F.array_max(
            F.transform(parts, lambda p: F.struct(F.char_length(p).alias("size"), p.alias("word")))
        )["word"].alias("term"),
    )
    two_pairs = vocabulary_matches(pieces, two.select("term").distinct(), False).select("token", "term")
    short_candidates = (
        tokens.join(joinable(stored(two_pairs, "part-matches")), "token")
        .join(two, "term")
        .select("entry_id", F.col("phrase").alias("term"))
    )
    candidates = stored(long_candidates.unionByName(short_candidates).distinct(), "candidates")
    text = F.col("data_lc")
    return (
        index.join(candidates, "entry_id")
        .filter(F.contains(text, F.col("term")))
        .select(
            *ENTRY,
            "term",
            tx.count_substring(text, F.col("term")).alias("n"),
            (tx.has_whole_word(text, F.col("term")) if whole else F.lit(True)).alias("ok"),
        )
    )


def has_blank(term: Column) -> Column:
    return F.rlike(term, F.lit(r"\s"))


def indexed_hits(
    index: DataFrame,
    tokens: DataFrame,
    terms: DataFrame,
    whole: bool,
    pieces: DataFrame | None = None,
) -> DataFrame:
    """Term hits through the token index; phrases are verified on the candidate texts.

    ``pieces`` are those of a stored index; without them they are built from the tokens.
    """
    pieces = stored(build_pieces(tokens), "pieces") if pieces is None else pieces
    pairs = stored(vocabulary_matches(pieces, terms.filter(~has_blank(F.col("term"))), whole), "word-matches")
    word_hits = (
        tokens.join(joinable(pairs), "token")
        .groupBy(*ENTRY, "term")
        .agg(F.sum(F.col("n") * F.col("times")).cast("int").alias("n"), F.max("ok").alias("ok"))
    )
    phrases = terms.filter(has_blank(F.col("term")))
    return word_hits.unionByName(phrase_text_hits(index, tokens, phrases, pieces, whole))


# Queries of one word that lie in one list.
TOGETHER = 64


def query_hits(
    index: DataFrame,
    asked: DataFrame,
    cfg: SearchConfig,
    whole: bool,
    tokens: DataFrame | None = None,
    pieces: DataFrame | None = None,
) -> DataFrame:
    """``(entry_id, section_id, times, direct, matches)``: lists of what an entry holds, with the query's
    columns, ``n`` and ``ok``. A term comes once for each token that holds it, or ``direct`` from a text.

    ``asked`` has a ``probe`` and, as ``query``, what is handed on. A token meets the list of all that
    it holds, so the tokens of an entry are moved once and not once for each word found in them; the
    lists are short, since a token holds few words, and a word's queries come in parts.
    ``tokens`` and ``pieces`` are prepared with the texts; without them they are built and stored.
    """
    match = F.struct("query.*", "n", "ok")
    probes = asked.select(F.col("probe").alias("term")).distinct()
    if cfg.method == "scan":
        found = scan_hits(index, probes, whole)
        words = None
    else:
        tokens = stored(build_token_index(index), "tokens") if tokens is None else tokens
        pieces = stored(build_pieces(tokens), "pieces") if pieces is None else pieces
        probes = stored(probes, "terms")
        place = F.row_number().over(Window.partitionBy("probe").orderBy("query"))
        parts = asked.withColumn("part", F.floor((place - 1) / TOGETHER))
        pairs = vocabulary_matches(pieces, probes.filter(~has_blank(F.col("term"))), whole)
        held = (
            pairs.withColumnRenamed("term", "probe")
            .join(parts, "probe")
            .repartition("token")
            .groupBy("token", "part")
            .agg(F.collect_list(match).alias("matches"))
        )
        words = tokens.join(held, "token").select(*ENTRY, "times", F.lit(False).alias("direct"), "matches")
        phrases = stored(probes.filter(has_blank(F.col("term"))), "phrases")
        found = phrase_text_hits(index, tokens, phrases, pieces, whole)
    hits = found.withColumnRenamed("term", "probe").join(joinable(asked), "probe")
    hits = hits.select(*ENTRY, F.lit(1).alias("times"), F.lit(True).alias("direct"), F.array(match).alias("matches"))
    return hits if words is None else words.unionByName(hits)


def with_stem_probes(terms: DataFrame) -> DataFrame:
    """Terms with each ``probe`` they are looked up by: included words also by their stem."""
    single = terms.filter(~F.col("excluded") & ~F.contains("term", F.lit(" ")))
    stems = stem_vocabulary(single.select(F.col("term")).distinct(), "term")
    stemmed = single.join(stems.filter("stem != term and stem != ''"), "term").withColumnRenamed("stem", "probe")
    return terms.withColumn("probe", F.col("term")).unionByName(stemmed.select(*terms.columns, "probe"))


def folded(index: DataFrame) -> DataFrame:
    """The texts that searches run on without accents; the stored ones stay as they are."""
    return index.withColumn("data_lc", tx.without_accents(F.col("data_lc")))


# Terms of a query that are the bits of one number.
BITS = 60


def most_terms(asked: DataFrame) -> int:
    """The most terms that a query has: one number out of its terms."""
    return asked.agg(F.max(F.abs("query.at")).alias("most")).first()["most"] or 0


def match_terms(
    index: DataFrame,
    terms: DataFrame,
    resolved: DataFrame,
    cfg: SearchConfig,
    mode: str = "like",
    tokens: DataFrame | None = None,
    pieces: DataFrame | None = None,
    settings: DataFrame | None = None,
) -> DataFrame:
    """Entries that hold every included term and no excluded one, in the query's sections.

    ``keywords_matched`` counts the included terms found, ``occurrences`` sums how often
    they occur; both are 1 for queries that only exclude. Queries without terms match
    nothing. With ``fold_accents`` texts and terms are compared without accents; ``tokens`` and
    ``pieces`` must then come from ``folded`` texts. The hits get the columns that ``settings`` has
    for their query, where it is given.

    All that a hit needs of its query goes with it. So hits are moved once, by entry, and neither
    they nor their sums meet a table of all queries.
    """
    check_choice("mode", mode, ("like", "regexp"))
    whole = mode == "regexp"
    index = in_sections(index, resolved)
    if cfg.fold_accents:
        index = folded(index)
        terms = terms.withColumn("term", tx.without_accents(F.col("term"))).distinct()
    needs = terms.groupBy("qid").agg(F.count_if(~F.col("excluded")).alias("needed"))
    needs, areas = scoped(needs, resolved)
    if settings is not None:
        row = F.struct(*[c for c in settings.columns if c != "qid"])
        lists = settings.groupBy("qid").agg(F.sort_array(F.collect_list(row)).alias("list"))
        members, kinds = numbered(lists, "kind")
        needs = needs.join(joinable(members), "qid")
    needs = stored(needs, "query-needs")
    handed = [c for c in needs.columns if c != "scope"]

    # The terms of a query by number, those that must not occur by a negative one.
    place = F.row_number().over(Window.partitionBy("qid").orderBy("excluded", "term"))
    listed = terms.distinct() if cfg.match_stems else terms
    listed = listed.withColumn("at", F.when(F.col("excluded"), -place).otherwise(place))
    probes = with_stem_probes(listed) if cfg.match_stems else listed.withColumn("probe", F.col("term"))
    located = F.col("probe") == F.col("term")
    query = F.struct(*needs.columns, "at", located.alias("located")).alias("query")
    asked = stored(probes.join(joinable(needs), "qid").select("probe", query), "asked")
    found = query_hits(index, asked, cfg, whole, tokens, pieces)

    # Queries that only exclude start from every entry of their sections.
    only = F.struct(
        *needs.columns, F.lit(0).alias("at"), F.lit(False).alias("located"), F.lit(0).alias("n"), F.lit(False).alias("ok")
    )
    pick = needs.filter(F.col("needed") == 0).join(areas, "scope").select("section_id", F.array(only).alias("matches"))
    base = index.select(*ENTRY).join(pick, "section_id").select(
        *ENTRY, F.lit(1).alias("times"), F.lit(True).alias("direct"), "matches"
    )

    rows = (
        found.unionByName(base)
        .repartition("entry_id")
        .select(*ENTRY, "times", "direct", F.inline("matches"))
        .join(areas, ["scope", "section_id"], "left_semi")
    )
    # A stem that is found says that its word is there, not how often.
    direct = F.col("direct")
    n = F.when(F.col("located"), F.col("n") * F.col("times")).otherwise(0)
    rows = rows.select(*ENTRY, *handed, "at", direct, "ok", "located", n.alias("n"))
    if cfg.match_stems:
        often = F.greatest(F.sum(F.when(~direct, F.col("n"))), F.max(F.when(direct, F.col("n")).cast("long")))
        rows = rows.groupBy(*ENTRY, *handed, "at").agg(
            F.lit(False).alias("direct"), F.max("ok").alias("ok"), F.max("located").alias("located"), often.alias("n")
        )

    # The included terms that the tokens of an entry hold are bits of a number, BITS terms a row; hits
    # from texts are counted.
    included, excluded = F.col("at") > 0, F.col("at") < 0
    block = F.floor(F.abs("at") / BITS).alias("block")
    one = F.expr(f"shiftleft(1L, at % {BITS})")

    def counted(what: Column) -> Column:
        held = F.bit_or(F.when(included & what & ~direct, one).otherwise(0))
        return F.bit_count(held) + F.count_if(included & what & direct)

    keys = [*ENTRY, *handed]
    per_entry = rows.groupBy(*keys, block).agg(
        counted(F.col("ok")).alias("included"),
        F.max(excluded & F.col("ok")).alias("forbidden"),
        counted(F.col("located")).alias("located"),
        F.sum(F.when(included, F.col("n")).otherwise(0)).alias("n"),
    )
    if most_terms(asked) >= BITS:
        sums = [F.sum(c).alias(c) for c in ("included", "located", "n")]
        per_entry = per_entry.groupBy(*keys).agg(F.max("forbidden").alias("forbidden"), *sums)
    hits = per_entry.filter(~F.col("forbidden") & (F.col("included") == F.col("needed")))
    only_excludes = F.col("needed") == 0
    columns = [
        "qid",
        *ENTRY,
        F.when(only_excludes, 1).otherwise(F.col("located")).cast("int").alias("keywords_matched"),
        F.when(only_excludes, 1).otherwise(F.col("n")).cast("double").alias("occurrences"),
    ]
    if settings is None:
        return hits.select(*columns)
    return hits.join(kinds, "kind").select(*columns, F.inline("list"))


def boolean_terms(queries: DataFrame, cfg: SearchConfig, column: str = "adjusted") -> DataFrame:
    """``(qid, sign, word, prefix, phrase)`` of a boolean full-text query.

    ``sign`` is ``+``, ``-`` or empty; ``phrase`` holds the cleaned quoted text on each of
    its keywords (a single quoted word is just a word), and ``prefix`` marks words written with
    a trailing ``*``. Words that are no keywords play no part, but a phrase stays an item even
    if none of its words is one: it then has one row, without a word.
    """
    raw = F.explode(F.regexp_extract_all(F.lower(column), F.lit(r'[+-]?"[^"]+"|[^ "]+'), F.lit(0)))
    items = queries.select("qid", raw.alias("raw")).select(
        "qid",
        F.regexp_extract("raw", "^[+-]", 0).alias("sign"),
        F.contains("raw", F.lit('"')).alias("quoted"),
        (~F.contains("raw", F.lit('"')) & F.endswith("raw", F.lit("*"))).alias("prefix"),
        F.trim(tx.strip_punctuation(F.regexp_replace("raw", r'^[+-]|"', ""))).alias("body"),
    )
    items = items.filter("body != ''").withColumn(
        "phrase", F.when(F.col("quoted") & F.contains("body", F.lit(" ")), F.col("body"))
    )
    words = F.split("body", " ")
    wanted = F.when(
        F.col("phrase").isNotNull(), F.filter(words, lambda w: is_keyword(w, cfg))
    ).otherwise(F.filter(words, lambda w: length_gate(w, cfg)))
    rows = items.select("qid", "sign", "prefix", "phrase", F.explode_outer(wanted).alias("word"))
    return rows.filter("word IS NOT NULL OR phrase IS NOT NULL").distinct()


def query_keywords(terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Terms with the dictionary keyword they stand for (several for ``word*``)."""
    exact = terms.filter(~F.col("prefix")).withColumn("keyword", F.col("word"))
    size = F.least(F.lit(3), F.char_length("word"))
    starts = dictionary.select(
        "keyword", F.explode(F.array_distinct(F.array(*[F.left("keyword", F.lit(i)) for i in (1, 2, 3)]))).alias("start")
    )
    wild = (
        terms.filter("prefix")
        .withColumn("start", F.left("word", size))
        .join(starts, "start")
        .filter(F.startswith("keyword", F.col("word")))
        .drop("start")
    )
    return exact.unionByName(wild)


# Ways in which the postings of one keyword are spread.
SALTS = 8


def with_postings(postings: DataFrame, words: DataFrame) -> DataFrame:
    """Postings of the stored words' keywords; those of a common one come from several tasks."""
    words = joinable(words)
    every = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt")
    salt = F.pmod(F.xxhash64("entry_id"), F.lit(SALTS)).alias("salt")
    return postings.select("*", salt).join(words.select("*", every), ["keyword", "salt"]).drop("salt")


def phrase_hits(positions: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(phrase, entry_id, section_id)`` where the words of a phrase follow each other.

    The rarest word of a phrase picks the entries; the places of each word, moved back by where it
    stands in the phrase, must have one in common. No text is read.
    """
    words = phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("behind", "token"))
    words = stored(words, "phrase-words")
    # Only the lists of the phrases' words are moved and read again.
    positions = positions.select("entry_id", "section_id", "token", "places").join(
        joinable(words.select("token").distinct()), "token", "left_semi"
    )
    positions = stored(positions, "phrase-positions")
    sizes = positions.groupBy("token").agg(F.count(F.lit(1)).alias("entries"))
    rarest = (
        words.join(sizes, "token", "left")
        .groupBy("phrase")
        .agg(
            F.min(F.struct(F.coalesce("entries", F.lit(0)), "token")).alias("pick"),
            F.count(F.lit(1)).alias("length"),
        )
        .select("phrase", "length", F.col("pick.token").alias("token"))
    )
    picked = positions.select("entry_id", "section_id", "token").join(rarest, "token").drop("token")
    looked = picked.join(words, "phrase")
    moved = F.transform("places", lambda p: p - F.col("behind")).alias("starts")
    lists = (
        looked.join(positions.select("entry_id", "token", "places"), ["entry_id", "token"])
        .select("phrase", "entry_id", "section_id", "length", moved)
        .groupBy("phrase", "entry_id", "section_id", "length")
        .agg(F.collect_list("starts").alias("lists"))
        .filter(F.size("lists") == F.col("length"))
    )
    common = F.aggregate("lists", F.col("lists")[0], F.array_intersect)
    return lists.filter(F.size(common) > 0).select("phrase", "entry_id", "section_id")


def match_fulltext(
    postings: DataFrame,
    dictionary: DataFrame,
    positions: DataFrame,
    terms: DataFrame,
    resolved: DataFrame,
) -> DataFrame:
    """Boolean full-text matches ``(qid, entry_id, section_id)``.

    Words marked + must occur, words marked - must not; without any + word at least one
    unsigned word must occur. The words of a phrase, keywords or not, must follow each other.
    """
    words = query_keywords(terms.filter("phrase IS NULL"), dictionary)
    keyed, areas = scoped(words.select("qid", "sign", "word", "keyword"), resolved)
    keyed = stored(keyed, "query-keywords")
    rows = with_postings(postings.select("entry_id", "section_id", "keyword"), keyed).join(
        areas, ["scope", "section_id"], "left_semi"
    )
    asked = terms.filter("phrase IS NOT NULL").select("qid", "sign", "phrase").distinct()
    asked = stored(asked, "query-phrases")
    phrase_rows = (
        phrase_hits(positions, asked.select("phrase").distinct())
        .join(asked, "phrase")
        .join(resolved.select("qid", "section_id"), ["qid", "section_id"], "left_semi")
        .select("qid", "entry_id", "section_id", "sign", F.col("phrase").alias("item"), F.lit(True).alias("quoted"))
    )
    word_rows = rows.select(
        "qid", "entry_id", "section_id", "sign", F.col("word").alias("item"), F.lit(False).alias("quoted")
    )
    required = F.when(F.col("sign") == "+", F.struct("quoted", "item"))
    needs = (
        terms.select("qid", "sign", F.coalesce("phrase", "word").alias("item"), F.col("phrase").isNotNull().alias("quoted"))
        .groupBy("qid")
        .agg(F.count_distinct(required).alias("needed"))
    )
    return (
        word_rows.unionByName(phrase_rows)
        .distinct()
        .groupBy("qid", "entry_id", "section_id")
        .agg(
            F.count_if(F.col("sign") == "+").alias("have"),
            F.count_if(F.col("sign") == "-").alias("forbidden"),
            F.count_if(F.col("sign") == "").alias("optional"),
        )
        .join(needs, "qid")
        .filter((F.col("forbidden") == 0) & (F.col("have") == F.col("needed")))
        .filter((F.col("needed") > 0) | (F.col("optional") > 0))
        .select("qid", "entry_id", "section_id")
    )


# Queries and entries of a block; a group of queries meets all blocks of entries.
BLOCK_QUERIES, BLOCK_ENTRIES = 6000, 300


def block_of(entry: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(entry), F.lit(blocks)).alias("block")


def word_lists(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbers of keywords, and per query the list of its ``words`` in numbers, from ``(qid, keyword)``."""
    numbers = words.select("keyword").distinct().withColumn("word", F.monotonically_increasing_id())
    numbers = stored(numbers, "word-numbers")
    lists = words.join(joinable(numbers), "keyword").groupBy("qid").agg(F.collect_list("word").alias("words"))
    return numbers, lists


def scores_by_blocks(queries: DataFrame, parts: DataFrame, blocks: int, groups: int) -> DataFrame:
    """``qid, entry_id, section_id, relevance``: the sums of the parts that words add to entries.

    ``queries`` have ``words`` and either ``sections``, for every pair that shares a word, or the entries
    ``wanted`` in one ``block``. Each group of queries meets each block of entries once, as two tables
    whose pairs are summed in memory, so that no row for a query, an entry and a word is ever moved.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    group = F.pmod(F.xxhash64("qid"), F.lit(groups)).alias("group")
    if "block" not in queries.columns:
        queries = queries.select("*", every(blocks).alias("block"))
    parts = parts.select("*", block_of("entry_id", blocks))
    schema = T.StructType(
        [queries.schema["qid"], *T.StructType.fromDDL("entry_id LONG, section_id INT, relevance DOUBLE")]
    )
    return (
        queries.select("*", group)
        .groupBy("block", "group")
        .cogroup(parts.select("*", every(groups).alias("group")).groupBy("block", "group"))
        .applyInArrow(block_scores, schema)
    )


def every_score(
    postings: DataFrame, words: DataFrame, resolved: DataFrame, frequency: DataFrame
) -> DataFrame:
    """The relevance of every entry that shares a word with a query, in its sections."""
    lengths = stored(postings.groupBy("entry_id").agg(F.sum("tf").alias("doc_len")), "entry-lengths")
    corpus = lengths.agg(F.count(F.lit(1)).alias("docs"), F.avg("doc_len").alias("avg_len"))
    words = stored(words, "asked-words")
    numbers, lists = word_lists(words)
    sections = F.array_sort(F.collect_set(F.col("section_id").cast("int"))).alias("sections")
    sections = resolved.filter("section_id IS NOT NULL").groupBy("qid").agg(sections)
    lists = stored(lists.join(sections, "qid"), "query-lists")
    known = stored(numbers.join(frequency, "keyword"), "asked-numbers")
    part = bm25(
        F.col("tf"),
        F.col("doc_len"),
        corpus.select("avg_len").scalar(),
        corpus.select("docs").scalar(),
        F.col("df"),
    )
    rows = postings.select("entry_id", "section_id", "keyword", "tf").filter("section_id IS NOT NULL")
    parts = rows.join(joinable(known), "keyword").join(lengths, "entry_id")
    parts = parts.select("entry_id", "section_id", "word", part.alias("part"))
    blocks, groups = -(-lengths.count() // BLOCK_ENTRIES) or 1, -(-lists.count() // BLOCK_QUERIES) or 1
    return scores_by_blocks(lists, parts, blocks, groups)


def fulltext_relevance(
    postings: DataFrame,
    dictionary: DataFrame,
    terms: DataFrame,
    resolved: DataFrame,
    totals: DataFrame | None = None,
    hits: DataFrame | None = None,
) -> DataFrame:
    """BM25 of each (query, entry) over the query's words that are not forbidden.

    Corpus numbers come from the whole index. With ``hits`` only those (query, entry) pairs are
    scored, without them all pairs, by blocks of queries and entries. Rounded to six places, so equal texts rank equally whatever the order of summation.
    """
    asked = terms.filter("sign != '-' AND word IS NOT NULL")
    words = query_keywords(asked, dictionary).select("qid", "keyword").distinct()
    totals = keyword_totals(postings) if totals is None else totals
    frequency = totals.groupBy("keyword").agg(F.sum("entries").alias("df"))
    if hits is None:
        scores = every_score(postings, words, resolved, frequency)
        return scores.withColumn("relevance", F.round("relevance", 6))
    lengths = postings.groupBy("entry_id").agg(F.sum("tf").alias("doc_len"))
    corpus = lengths.agg(
        F.count(F.lit(1)).alias("docs"), F.avg("doc_len").alias("avg_len")
    )
    words, areas = scoped(words.join(frequency, "keyword"), resolved)
    words = stored(words, "query-words")
    rows = with_postings(postings.select("entry_id", "section_id", "keyword", "tf"), words).join(
        areas, ["scope", "section_id"], "left_semi"
    )
    rows = rows.join(hits.select("qid", "entry_id"), ["qid", "entry_id"], "left_semi").join(lengths, "entry_id")
    part = bm25(
        F.col("tf"),
        F.col("doc_len"),
        corpus.select("avg_len").scalar(),
        corpus.select("docs").scalar(),
        F.col("df"),
    )
    return (
        rows.groupBy("qid", "entry_id", "section_id")
        .agg(F.sum(part).alias("relevance"))
        .withColumn("relevance", F.round("relevance", 6))
    )
