"""Counting keywords inside texts, on Arrow batches.

Sent to the workers as code, so they need not have this package installed.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts counted before their rows are handed back to Spark.
ROWS_PER_OUTPUT = 200


def substring_counts(text: str, keywords: list[str]) -> tuple[list[int], list[int]]:
    """The frequency and the tf of each keyword in one text."""
    return token_counts(Counter(text.split(" ")), keywords)


def token_counts(tokens: Counter[str], keywords: list[str]) -> tuple[list[int], list[int]]:
    """The frequency and the tf of each keyword, from how often a text has each token.

    A keyword holds no blank, so each of its occurrences lies inside one token: one automaton of
    all keywords reads every distinct token once, those of equal number in one go. Linear in the
    text and in what is found, where counting keyword by keyword reads the whole text once for each
    of them; an occurrence that overlaps the last counted one of its keyword doesn't count.
    """
    frequency = [0] * len(keywords)
    if keywords:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, keyword in enumerate(keywords):
            automaton.add_word(keyword, i)
        automaton.make_automaton()
        equally_often: dict[int, list[str]] = {}
        for token, n in tokens.items():
            equally_often.setdefault(n, []).append(token)
        sizes = [len(k) for k in keywords]
        # Places go on from one go to the next, so that the last ones count for all.
        ends = [-1] * len(keywords)
        behind = 0
        for n, group in equally_often.items():
            joined = " ".join(group)
            for end, i in automaton.iter(joined):
                end += behind
                if end - sizes[i] >= ends[i]:
                    ends[i] = end
                    frequency[i] += n
            behind += len(joined) + 1
    return frequency, [tokens[k] for k in keywords]


def keyword_test(
    shortest: int, longest: int, starts: tuple[str, ...], ends: tuple[str, ...], parts: tuple[str, ...]
) -> Callable[[str, Iterable[str]], list[str]]:
    """A function of a text and its tokens that gives the tokens which are keywords.

    Keywords have ``shortest`` characters or more and less than ``longest`` bytes, and no sign of code.
    Signs are looked for in the whole text first, since few texts hold one.
    """
    signs = (*starts, *ends, *parts)

    def keywords_of(text: str, tokens: Iterable[str]) -> list[str]:
        # A character has four bytes at most, so that most words need no second look.
        words = [
            w
            for w in tokens
            if shortest <= len(w) < longest and (4 * len(w) < longest or len(w.encode()) < longest)
        ]
        if any(sign in text for sign in signs):
            words = [
                w
                for w in words
                if not w.startswith(starts) and not w.endswith(ends) and not any(p in w for p in parts)
            ]
        return words

    return keywords_of


def count_batches(
    batches: Iterator[pa.RecordBatch], keywords_of: Callable[[str, Iterable[str]], list[str]] | None = None
) -> Iterator[pa.RecordBatch]:
    """Without ``keywords_of``, the keywords of each text come joined by blanks; null stands for none."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_OUTPUT):
            part = batch.slice(start, ROWS_PER_OUTPUT).to_pydict()
            words, frequency, tf, sizes = [], [], [], []
            for i, text in enumerate(part["text"]):
                tokens = Counter(text.split(" "))
                if keywords_of:
                    keywords = keywords_of(text, tokens)
                else:
                    joined = part["keywords"][i]
                    keywords = [] if joined is None else joined.split(" ")
                frequencies, tfs = token_counts(tokens, keywords)
                words += keywords
                frequency += frequencies
                tf += tfs
                sizes.append(len(keywords))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(part["entry_id"], sizes), pa.int64()),
                    pa.array(np.repeat(part["section_id"], sizes), pa.int32()),
                    pa.array(words, pa.string()),
                    pa.array(frequency, pa.int32()),
                    pa.array(tf, pa.int32()),
                ],
                names=["entry_id", "section_id", "keyword", "frequency", "tf"],
            )


def counting_of(
    keywords_of: Callable[[str, Iterable[str]], list[str]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``count_batches`` for texts without keywords, as Spark calls it."""
    return lambda batches: count_batches(batches, keywords_of)
