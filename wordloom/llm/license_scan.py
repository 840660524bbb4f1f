"""License notices by an exact set-similarity join, with built-in functions only.

Tokens are ordered by how often they occur in the whole table, rare ones first. A block and a
template that share enough tokens share one among the first few of both (prefix filter); blocks
too short for a template drop out (length filter), and so do pairs whose common token lies too far
back (positional filter). What is left is counted exactly. Templates are a parameter of a few
lines, so the index of their prefixes is a small fixed table.

Two kinds of blocks are joined: the lines of a text, and the words around each line break, against
notice templates by containment, and whole texts against phrases, whose words must all occur; the places where a phrase's words then
really stand next to each other are read off the marked words of the text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored, texts
from wordloom.session import local_table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases whose places are counted, with their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# Lines of license notices, with their labels.
TEMPLATES = (
    ("licensed under cc by", "cc"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("licensed under cc by nd", "cc-by-nd"),
    ("licensed under a creative commons attribution international license", "cc"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version", "apache"),
    ("this work is licensed under the gnu general public license version", "gpl-notice"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("copyright all rights reserved", "copyright"),
)
# Share of a template's words that a line must hold.
CONTAINMENT = 0.9

LINE, WHOLE = 0, 1


@dataclass(frozen=True)
class Template:
    number: int
    kind: int
    label: str
    words: tuple[str, ...]
    need: int

    @property
    def tokens(self) -> set[str]:
        return set(self.words)


def templates_of(templates, phrases, containment: float) -> list[Template]:
    made = []
    for kind, entries, share in ((LINE, templates, containment), (WHOLE, phrases, 1.0)):
        for text, label in entries:
            words = tuple(text.split())
            need = math.ceil(share * len(set(words)) - 1e-9)
            made.append(Template(len(made), kind, label, words, max(1, need)))
    return made


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def literals(values) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)])


def around_breaks(lines: Column, reach: int) -> Column:
    """The words around each break between two lines with words: the last ``reach`` words before it
    and the next ``reach`` after it, however many more lines these take.

    A notice of up to ``reach`` words that does not lie within a line lies around the first break in it.
    """
    filled = F.filter(lines, lambda line: F.size(line) > 0)
    heads = F.transform(filled, lambda line: F.slice(line, 1, reach))
    # Each of the following lines has a word at least, so this many of them hold enough.
    after = lambda i: F.slice(F.flatten(F.slice(heads, i + 2, reach)), 1, reach)
    tail = lambda line: F.slice(line, F.greatest(F.size(line) - reach, F.lit(0)) + 1, F.lit(reach))
    breaks = F.transform(filled, lambda line, i: F.concat(tail(line), after(i)))
    return F.slice(breaks, 1, F.greatest(F.size(filled) - 1, F.lit(0)))


def blocks_of(docs: DataFrame, wanted: list[Template]) -> DataFrame:
    """``row, doc_id, n_words, blocks, marks``, written once.

    Blocks keep only words of some template; a block too short for every template is left out. Blocks
    of notices are the lines and the words around line breaks.
    Marks are the places of a phrase's first word, with as many words from there as the longest
    phrase has.
    """
    lines = [t for t in wanted if t.kind == LINE]
    phrases = [t for t in wanted if t.kind == WHOLE]
    line_words = literals(set().union(*[t.tokens for t in lines]))
    phrase_words = literals(set().union(*[t.tokens for t in phrases]))
    starts = literals({t.words[0] for t in phrases})
    longest = max(len(t.words) for t in phrases)
    shortest = min(t.need for t in lines)
    reach = max(len(t.words) for t in lines)

    # An exploded array of one is computed once, whatever reads it.
    split = F.transform(F.split("text", "\n"), lambda line: words_of(line))
    rows = texts(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.explode(F.array(split)).alias("split")
    )
    rows = rows.select("*", F.explode(F.array(F.flatten("split"))).alias("words"))
    cut = F.filter(
        F.transform(
            F.concat("split", around_breaks(F.col("split"), reach)),
            lambda words, i: F.struct(
                F.lit(LINE).alias("kind"), i.alias("no"), F.array_intersect(words, line_words).alias("tokens")
            ),
        ),
        lambda block: F.size(block["tokens"]) >= shortest,
    )
    whole = F.array(
        F.struct(
            F.lit(WHOLE).alias("kind"),
            F.lit(0).alias("no"),
            F.array_intersect("words", phrase_words).alias("tokens"),
        )
    )
    places = F.filter(
        F.transform("words", lambda word, i: F.struct(i.alias("at"), word.alias("word"))),
        lambda mark: F.array_contains(starts, mark["word"]),
    )
    marks = F.transform(
        places,
        lambda mark: F.struct(
            mark["at"].alias("at"), F.slice(F.col("words"), mark["at"] + 1, longest).alias("words")
        ),
    )
    return stored(
        rows.select(
            "row",
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.concat(cut, whole).alias("blocks"),
            marks.alias("marks"),
        ),
        "license-blocks",
    )


def frequency_ranks(blocks: DataFrame, wanted: list[Template]) -> dict[str, int]:
    """Rank of each template word by the number of blocks that hold it, rare words first.

    The result has one entry for each word of the templates, whatever the table's size.
    """
    tokens = blocks.select(F.explode(F.flatten("blocks.tokens")).alias("token"))
    counted = {r["token"]: r["n"] for r in tokens.groupBy("token").agg(F.count("*").alias("n")).collect()}
    words = sorted(set().union(*[t.tokens for t in wanted]), key=lambda w: (counted.get(w, 0), w))
    return {word: rank for rank, word in enumerate(words)}


def similar(blocks: DataFrame, wanted: list[Template], ranks: dict[str, int]) -> DataFrame:
    """``row, kind, marks, template, label, phrase, containment`` of all blocks over the threshold."""
    index = []
    for t in wanted:
        order = sorted(ranks[w] for w in t.tokens)
        phrase = list(t.words) if t.kind == WHOLE else None
        for at, rank in enumerate(order[: len(order) - t.need + 1]):
            index.append((t.kind, rank, t.number, t.label, phrase, at, order, t.need))
    prefixes = local_table(
        blocks.sparkSession,
        index,
        "kind int, rank int, template int, label string, phrase array<string>, at int, "
        "template_ranks array<int>, need int",
    )
    rank_of = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    block = blocks.select("row", "marks", F.inline("blocks"))
    order = F.array_sort(F.transform("tokens", lambda word: rank_of[word]))
    block = block.select(
        "row", "kind", F.when(F.col("kind") == WHOLE, F.col("marks")).alias("marks"),
        F.explode(F.array(order)).alias("ranks"),
    )
    # The longest prefix that any template of the kind asks for.
    least = {k: min(t.need for t in wanted if t.kind == k) for k in (LINE, WHOLE)}
    need = F.when(F.col("kind") == LINE, least[LINE]).otherwise(least[WHOLE])
    prefix = F.slice("ranks", F.lit(1), F.greatest(F.size("ranks") - need + 1, F.lit(0)))
    probes = block.select("*", F.posexplode(prefix).alias("place", "rank"))
    size, template_size = F.size("ranks"), F.size("template_ranks")
    pairs = probes.join(F.broadcast(prefixes), ["kind", "rank"]).filter(
        (size >= F.col("need"))
        & (F.col("place") <= size - F.col("need"))
        & (1 + F.least(size - F.col("place"), template_size - F.col("at")) - 1 >= F.col("need"))
    )
    shared = F.array_intersect("ranks", "template_ranks")
    # A pair with several common prefix tokens counts once, at the first of them.
    return pairs.filter(
        (F.size(shared) >= F.col("need")) & (F.array_min(shared) == F.col("rank"))
    ).select(
        "row", "kind", "marks", "template", "label", "phrase",
        (F.size(shared) / template_size).alias("containment"),
    )


def scan(
    docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, containment: float = CONTAINMENT
) -> DataFrame:
    """One row for each document: its words, the phrases' places and the labels found.

    Null texts count as empty and have no words. ``n_base`` counts all places of all phrases,
    ``first_word`` and ``last_word`` are null without one; label lists are then empty strings.
    ``score`` is the largest containment reached, 0 if none reached its threshold. Repeated rows
    and null ids get a row each; columns other than id and text play no part.
    """
    wanted = templates_of(templates, phrases, containment)
    blocks = blocks_of(docs, wanted)
    found = similar(blocks, wanted, frequency_ranks(blocks, wanted))
    starts = F.transform(
        F.filter(
            "marks",
            lambda m: F.slice(m["words"], F.lit(1), F.size("phrase")) == F.col("phrase"),
        ),
        lambda m: m["at"],
    )
    starts = F.when(F.col("kind") == WHOLE, starts).otherwise(F.array().cast("array<int>"))
    found = found.select("row", "kind", "label", "containment", F.explode(F.array(starts)).alias("starts"))
    found = found.filter((F.col("kind") == LINE) | (F.size("starts") > 0))
    base = F.when(F.col("kind") == WHOLE, F.col("label"))
    per_row = found.groupBy("row").agg(
        F.sum(F.size("starts")).alias("places"),
        F.min(F.array_min("starts")).alias("first_word"),
        F.max(F.array_max("starts")).alias("last_word"),
        F.collect_set(base).alias("base"),
        F.collect_set("label").alias("all"),
        F.max("containment").alias("containment"),
    )
    joined = blocks.select("row", "doc_id", "n_words").join(per_row, "row", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("places", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce(F.array_join(F.array_sort("base"), ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join(F.array_sort("all"), ","), F.lit("")).alias("labels"),
        F.coalesce("containment", F.lit(0.0)).alias("score"),
    )


def scan_sql(templates=TEMPLATES, phrases=PHRASES, containment: float = CONTAINMENT) -> str:
    """The same by comparing every line and line break with every template, in DuckDB's SQL."""
    wanted = templates_of(templates, phrases, containment)
    reach = max(len(t.words) for t in wanted if t.kind == LINE)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def listed(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    lines = ", ".join(
        f"({listed(sorted(t.tokens))}, '{t.label}', {t.need})" for t in wanted if t.kind == LINE
    )
    places = ", ".join(
        f"({listed(t.words)}, '{t.label}', {len(t.words)})" for t in wanted if t.kind == WHOLE
    )
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, {lower} AS text FROM documents
), w AS (
  SELECT row, doc_id, regexp_extract_all(text, '{word}') AS words FROM d
), template(words, label, need) AS (VALUES {lines}
), phrase(words, label, n) AS (VALUES {places}
), split AS (
  SELECT row, list_transform(string_split(text, chr(10)), lambda x: regexp_extract_all(x, '{word}')) AS lines FROM d
), filled AS (
  SELECT row, list_filter(lines, lambda x: len(x) > 0) AS lines FROM split
), line AS (
  SELECT row, list_distinct(words) AS words FROM (SELECT row, unnest(lines) AS words FROM split
  UNION ALL
  SELECT row, list_concat(lines[i][greatest(len(lines[i]) - {reach}, 0) + 1 :],
                          flatten(lines[i + 1 : i + {reach}])[1 : {reach}])
  FROM (SELECT row, lines, unnest(generate_series(1, len(lines) - 1)) AS i FROM filled))
), notice AS (
  SELECT l.row, t.label, len(list_intersect(l.words, t.words)) / len(t.words) AS containment
  FROM line l JOIN template t ON len(list_intersect(l.words, t.words)) >= t.need
), places AS (
  SELECT w.row, p.label, pos - 1 AS pos
  FROM w, phrase p, unnest(generate_series(1, len(w.words) - p.n + 1)) AS s(pos)
  WHERE w.words[pos] = p.words[1] AND w.words[pos : pos + p.n - 1] = p.words
), base AS (
  SELECT row, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY row
), every AS (
  SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
  FROM (SELECT row, label, containment FROM notice UNION ALL SELECT row, label, 1.0 FROM places)
  GROUP BY row
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base,
       b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(e.labels, '') AS labels,
       coalesce(e.score, 0)::DOUBLE AS score
FROM w LEFT JOIN base b ON b.row = w.row LEFT JOIN every e ON e.row = w.row
"""


SCAN_SQL = scan_sql()
