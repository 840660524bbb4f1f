"""Spelling variants: words one edit apart, by dynamic programming along sorted lists.

Two words one edit apart share the first half of the shorter one, or the second half. So the
vocabulary is sorted twice, by the words and by the words read backwards, and only the range of
words that share a half is scanned for a word. Within a range the edit matrix of the word against
every listed word is filled letter by letter: words with a common beginning share its rows, of which
three cells are kept (more edits than one can't come back), and a range of the list whose common
beginning is over one edit in all three is skipped as a whole. All words of a range, and all ranges
of a sorted run of rows, take the same step at once.

A range that many words share is cut into cells of bounded size, each of them some listed words
against some asked ones, so that no pair is lost and no task gets a whole hot range.

Defined results: texts that are null hold no words, a null id is written as nothing. Repeated rows
count as often as they occur. An empty table gives no rows. Words of any length are compared whole.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a run of letters is, and the letters that are lower-cased.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Shortest word, and how often it has to occur.
SHORTEST, OFTEN = 7, 2
# One run in so many loses a letter.
DAMAGED = 31
# A form occurs at least so many times as often.
STRONGER = 10
# Different words that a worker counts before it hands them on.
COUNTED = 200_000
# Words of a cell on average, and letters of one.
CELL_WORDS, CELL_LETTERS = 4096, 1 << 22
# Words that are scanned together.
TOGETHER = 20_000
# Ranges followed at once; beyond that the asked words are taken in parts.
FRONTIER = 2_000_000

PAIRS = "word string, n long, near string, near_n long"


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and how often they occur, summed up as far as memory is bounded."""
    # Shorter runs can't become long words; a greedy match is maximal.
    run = re.compile(f"[{LETTERS}]{{{SHORTEST},}}")
    lower = str.maketrans(UPPER, LOWER)
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        rows = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(rows, names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            text = text.as_py()
            if not text:
                continue
            key = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for word, n in Counter(run.findall(text.translate(lower))).items():
                h = zlib.crc32(word.encode(), key)
                if not h % DAMAGED:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < SHORTEST:
                        continue
                counts[word] += n
            if len(counts) >= COUNTED:
                yield out()
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of all texts, after the damage, that occur often enough."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    counted = rows.mapInArrow(count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN)


def halves(words: DataFrame) -> DataFrame:
    """``back, size, half, word, n``: each word under every half that a near one may share.

    ``size`` is the length of the shorter word of a pair, so that words of that length and of the
    next one meet; backwards, the words and their halves are turned round.
    """
    length = F.char_length("word")
    sizes = words.withColumn("size", F.explode(F.array(length, length - 1)))
    sizes = sizes.filter(F.col("size") >= SHORTEST)
    ways = sizes.withColumn("back", F.explode(F.array(F.lit(False), F.lit(True))))
    word = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    kept = F.floor(F.col("size") / 2).cast("int")
    kept = F.when(F.col("back"), F.col("size") - kept).otherwise(kept)
    return ways.withColumn("word", word).withColumn("half", F.left("word", kept))


def in_cells(words: DataFrame) -> DataFrame:
    """The halves cut into cells; a row is listed, asked, or both."""
    rows = halves(words)
    parts = F.greatest(
        F.ceil(F.col("words") / CELL_WORDS),
        F.ceil(F.col("words") * (F.col("size") + 1) / CELL_LETTERS),
    ).cast("int")
    large = (
        rows.groupBy("back", "size", "half")
        .agg(F.count(F.lit(1)).alias("words"))
        .withColumn("parts", parts)
        .filter("parts > 1")
        .drop("words")
    )
    rows = rows.join(large, ["back", "size", "half"], "left")
    rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    rows = rows.select("back", "size", "half", "word", "n", "parts", own.alias("own"), every)
    same = F.col("own") == F.col("other")
    places = F.array(
        F.struct(F.col("own").alias("row"), F.col("other").alias("column"), F.lit(True).alias("listed"), same.alias("asked")),
        F.struct(F.col("other").alias("row"), F.col("own").alias("column"), same.alias("listed"), F.lit(True).alias("asked")),
    )
    # The two are one where a row meets its own part.
    places = F.when(same, F.slice(places, 1, 1)).otherwise(places)
    return rows.select("back", "size", "half", "word", "n", F.inline(places))


class SortedList:
    """Rows of one direction and size, sorted by range, cell and word."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray, cells: np.ndarray):
        self.letters, self.lengths = letters, lengths
        # How many letters a word shares with the one before it; none across cells.
        same = letters[1:] == letters[:-1]
        shared = np.where(same.all(axis=1), letters.shape[1], same.argmin(axis=1))
        shared = np.where(cells[1:] == cells[:-1], shared, -1)
        self.shared = np.concatenate([[-1], shared])

    def near(self, asked: np.ndarray, first: np.ndarray, last: np.ndarray, depth: int):
        """Pairs (asked, listed) one edit apart, given ranges that share ``depth`` letters."""
        found = []
        # Cells of the edit matrix at [depth][depth - 1], [depth][depth] and [depth][depth + 1].
        row = np.empty((3, len(asked)), np.int8)
        row[0], row[1], row[2] = 1, 0, 1
        while len(asked):
            # A word that ends here stands first in its range.
            ends = self.lengths[first] == depth
            if ends.any():
                at = np.flatnonzero(ends)
                over = self.lengths[asked[at]] - depth + 1
                inside = (over >= 0) & (over <= 2)
                at, over = at[inside], over[inside]
                hit = row[over, at] == 1
                found.append((asked[at[hit]], first[at[hit]]))
                first = first + ends
                left = first < last
                asked, first, last, row = asked[left], first[left], last[left], row[:, left]
            # The next letters of a range: its first word, and each that shares no more than depth.
            turns = np.flatnonzero(self.shared <= depth)
            a, b = np.searchsorted(turns, first, "right"), np.searchsorted(turns, last, "left")
            counts = b - a + 1
            origin = np.repeat(np.arange(len(asked)), counts)
            place = np.arange(len(origin)) - np.repeat(np.cumsum(counts) - counts, counts)
            starts = np.where(place == 0, first[origin], 0)
            later = place > 0
            starts[later] = turns[a[origin[later]] + place[later] - 1]
            stops = last[origin]
            inner = place < counts[origin] - 1
            stops[inner] = turns[a[origin[inner]] + place[inner]]
            asked, row = asked[origin], row[:, origin]
            # One more row of the matrix; letters beyond the asked word's end are zero and differ.
            letter = self.letters[starts, depth]
            word = self.letters[asked, depth - 1 : depth + 2] if depth else None
            lengths = self.lengths[asked]
            new = np.empty_like(row)
            new[0] = np.minimum(row[0] + (word[:, 0] != letter), row[1] + 1)
            new[1] = np.minimum(np.minimum(row[1] + (word[:, 1] != letter), row[2] + 1), new[0] + 1)
            new[2] = np.minimum(row[2] + (word[:, 2] != letter), new[1] + 1)
            depth += 1
            for i in range(3):
                new[i][lengths < depth - 1 + i] = 2
            alive = (new < 2).any(axis=0)
            asked, first, last = asked[alive], starts[alive], stops[alive]
            row = np.minimum(new[:, alive], 2)
        if not found:
            return np.empty(0, int), np.empty(0, int)
        return tuple(np.concatenate(side) for side in zip(*found))


def scanned(rows: list[tuple], back: bool, size: int) -> list[tuple]:
    """``word, n, near, near_n`` of each asked word and listed word one edit apart."""
    words = [r[0].encode("latin-1") for r in rows]
    # Two zeros behind the longest, so that the band never leaves the table.
    width = size + 3
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    letters = letters.reshape(len(words), width)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    cells = np.fromiter((r[4] for r in rows), np.int64, len(rows))
    listed = np.fromiter((r[2] for r in rows), bool, len(rows))
    asked = np.fromiter((r[3] for r in rows), bool, len(rows))
    # The list holds listed rows; asked rows are looked up in the range of their cell.
    at = np.flatnonzero(listed)
    table = SortedList(letters[at], lengths[at], cells[at])
    first = np.searchsorted(cells[at], cells, "left")
    last = np.searchsorted(cells[at], cells, "right")
    kept = size // 2
    depth = size - kept if back else kept
    who = np.flatnonzero(asked & (last - first > (listed & asked)))
    out = []
    widths = np.cumsum(last[who] - first[who])
    cuts = np.searchsorted(widths, np.arange(FRONTIER, widths[-1], FRONTIER)) if len(who) else []
    for some in np.split(who, np.unique(cuts)) if len(who) else []:
        if not len(some):
            continue
        # The asked rows go behind the listed ones, so that one table holds the letters of both.
        table.letters = np.concatenate([letters[at], letters[some]])
        table.lengths = np.concatenate([lengths[at], lengths[some]])
        number = np.arange(len(at), len(at) + len(some))
        pairs = table.near(number, first[some], last[some], depth)
        for a, b in zip((some[pairs[0] - len(at)]).tolist(), at[pairs[1]].tolist()):
            # Words of the same length class only, and words that agree in both halves only once.
            if min(lengths[a], lengths[b]) == size and not (back and rows[a][0][-kept:] == rows[b][0][-kept:]):
                out.append((rows[a][0], rows[a][1], rows[b][0], rows[b][1]))
    if back:
        out = [(a[::-1], n, b[::-1], m) for a, n, b, m in out]
    return out


def scan_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, whole cells at a time."""

    def out(rows: list[tuple], of: tuple) -> pa.RecordBatch:
        sides = list(zip(*scanned(rows, *of))) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        arrays = [pa.array(s, k) for s, k in zip(sides, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "n", "near", "near_n"])

    run: list[tuple] = []
    cell: list[tuple] = []
    kind = key = None
    number = letters = 0
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("back", "size", "half", "row", "column", "word", "n", "listed", "asked")]
        for back, size, half, i, j, word, n, listed, asked in zip(*columns):
            if (back, size, half, i, j) != key:
                # A cell of one row has no pair.
                if len(cell) > 1:
                    run += cell
                    letters += len(cell) * (size + 3)
                if run and ((back, size) != kind or len(run) >= TOGETHER or letters >= CELL_LETTERS):
                    yield out(run, kind)
                    run, letters = [], 0
                cell, key, kind, number = [], (back, size, half, i, j), (back, size), number + 1
            cell.append((word, n, listed, asked, number))
    if len(cell) > 1:
        run += cell
    if run:
        yield out(run, kind)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: each two words one edit apart, both ways."""
    keys = ["back", "size", "half", "row", "column"]
    dealt = in_cells(words).repartition(*keys).sortWithinPartitions(*keys, "word")
    return dealt.mapInArrow(scan_runs, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the last form of each chain.

    A form occurs ten times as often as its word, so chains are short and have no rings; every
    round doubles the distance that is already covered.
    """
    ahead = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if ahead.join(step, "root", "left_semi").isEmpty():
            return ahead
        ahead = stored(
            ahead.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "roots",
        )


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    words = stored(vocabulary(docs), "vocabulary")
    pairs = near_words(words)
    alone = words.select(
        "word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")
    )
    candidate = F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))
    rows = alone.unionByName(pairs).withColumn(
        "candidate", F.when(F.col("near").isNotNull(), candidate)
    )
    best = rows.groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), F.min("candidate").alias("best")
    )
    strong = -F.col("best.n") >= STRONGER * F.col("n")
    named = stored(
        best.select(
            "word",
            "n",
            "n_near",
            F.when(strong, F.col("best.word")).alias("form"),
            F.when(strong, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(named.filter("form IS NOT NULL"))
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# Checksums are computed byte by byte from a table that follows from the reflected polynomial.
VARIANTS_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents WHERE text IS NOT NULL
), counted AS (
  SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS key
  FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(
           list_transform(range(length(hex(encode(key))) // 2), lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM counted, crc_table
), words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), one_way AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM one_way GROUP BY word, n
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.at AS root FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
