"""Toxicity by a weighted finite-state grammar over the words of a clause.

A lexicon transducer turns words into symbols: insults, threats, targets, first persons, negations,
verbs of speech, others; it also ends clauses. Five small transducers read the symbols of a clause.
Insult: one that follows another closely weighs more. Threat: it weighs little unless somebody, a
target or a first person, stands near it. Target: what stands in a clause with one weighs more.
Negation lowers the weight of what follows within a few words, reported speech that of the rest of
the clause. Each has a part that reads onward and one that reads back, and a factor for a word by
its symbol and the states of both parts next to it. They are composed with each other, and the
lexicon with the result, into one machine; it adds up a weight for each clause, and a document's
evidence is the sum over its clauses.

The lists hold words of English, German, French and Spanish together, since the language of a text
is no input: what is a target in one language is read as one in all. Insults beyond them are
learned: whole words and beginnings of words that stand in labelled toxic documents far more often
than chance allows. A logistic curve turns evidence into a score.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.bpe import portions
from wordloom.llm.common import fold, stored, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS = 5
# Labelled rows that the model is fitted to, at most; taken by a hash of the id.
SAMPLE = 20_000
# Times the gain that chance alone reaches once among all that is counted.
CAUTION = 1.5
# Lengths of the beginnings of words that are counted, beside whole words.
BEGINNINGS = (4, 5, 6)
# Words in which a negation, an insult and somebody near a threat reach.
REACH, HEAP, NEAR = 3, 2, 4
# Factors of negation, reported speech, a target, a further insult, and a threat to nobody.
NEGATED, REPORTED, TARGETED, HEAPED, UNAIMED = 0.5, 0.7, 1.3, 1.2, 0.25
# Weight of a word of the lists below until labels say more.
GIVEN = 3.0
# Words of the worker's symbol memory.
REMEMBERED = 150_000
# Features that a worker counts before it hands them on.
COUNTED = 200_000

# Word lists.
INSULTS = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting",
    "clown", "imbecile", "dumb", "filthy", "vermin", "pig", "bastard", "bitch", "asshole",
    "dummkopf", "vollidiot", "trottel", "arschloch", "abschaum", "versager", "hurensohn", "wichser",
    "imbécile", "crétin", "connard", "salaud", "ordure", "abruti", "salope", "débile",
    "imbécil", "estúpido", "estúpida", "escoria", "cabrón", "gilipollas", "idiota", "asqueroso",
)
THREATS = (
    "kill", "murder", "hurt", "destroy", "strangle", "shoot", "stab", "beat",
    "töten", "töte", "umbringen", "erschießen", "erstechen", "erwürgen", "verprügeln",
    "tuer", "tuerai", "frapper", "étrangler", "poignarder", "massacrer",
    "matar", "mataré", "golpear", "estrangular", "apuñalar", "disparar",
)
TARGETS = (
    "you", "your", "u", "they", "them", "people", "he", "she", "him", "her", "yourself", "you're",
    "du", "dich", "dir", "dein", "deine", "ihr", "euch", "er", "sie", "ihn", "ihm", "ihnen", "leute",
    "tu", "te", "toi", "ton", "vous", "votre", "il", "elle", "ils", "elles", "lui", "leur", "gens",
    "tú", "ti", "usted", "ustedes", "vosotros", "él", "ella", "ellos", "ellas", "eres", "gente",
)
# A word that begins with "j'" is a first person too.
SELVES = (
    "i", "i'll", "i'm", "we", "we'll", "ich", "wir", "je", "nous", "yo", "nosotros", "voy", "vamos",
)
# A word that ends with "n't" or begins with "n'" is a negation too.
NEGATIONS = (
    "not", "no", "never", "neither", "nor", "cannot", "without",
    "nicht", "kein", "keine", "keinen", "keiner", "niemals", "nie", "weder", "ohne",
    "ne", "pas", "jamais", "aucun", "aucune", "ni", "sans", "nunca", "jamás", "tampoco", "ningún",
)
SPEECH = (
    "said", "says", "wrote", "claimed", "quoted", "called", "reported", "told",
    "sagte", "sagt", "schrieb", "behauptete", "nannte", "meinte", "zitierte", "berichtete",
    "dit", "disait", "écrit", "affirme", "prétend", "appelait", "raconta", "déclare",
    "dijo", "decía", "escribió", "afirmó", "llamó", "contó", "citó", "declaró",
)

# Symbols.
OTHER, INSULT, THREAT, TARGET, SELF, NEGATION, REPORT = range(7)
SYMBOLS = range(7)
EDGES = re.compile(r"^\W+|\W+$")
CLAUSE_END = re.compile(r"[.!?;:]\W*$")

Steps = dict[tuple, Any]


@dataclass
class Transducer:
    """Two automata over a clause, one reading onward and one back, both from state 0, and the
    factor of a word: (state before it, its symbol, state behind it). A step is
    (state, symbol) -> state."""

    onward: Steps
    back: Steps
    factor: Callable[[Any, int, Any], float]


STAY: Steps = {(0, symbol): 0 for symbol in SYMBOLS}


def within(reach: int, *marks: int) -> Steps:
    """The state counts the words that the last of the marks still reaches."""
    return {
        (left, symbol): reach if symbol in marks else max(0, left - 1)
        for left in range(reach + 1)
        for symbol in SYMBOLS
    }


def seen(mark: int) -> Steps:
    """The state is 1 once the mark has been read."""
    return {(state, symbol): int(state or symbol == mark) for state in (0, 1) for symbol in SYMBOLS}


def weighs(symbol: int) -> bool:
    return symbol in (INSULT, THREAT)


def insult() -> Transducer:
    return Transducer(
        within(HEAP, INSULT), STAY, lambda before, x, behind: HEAPED if x == INSULT and before else 1.0
    )


def threat() -> Transducer:
    near = within(NEAR, TARGET, SELF)
    return Transducer(
        near, near, lambda before, x, behind: UNAIMED if x == THREAT and not (before or behind) else 1.0
    )


def target() -> Transducer:
    return Transducer(
        seen(TARGET),
        seen(TARGET),
        lambda before, x, behind: TARGETED if weighs(x) and (before or behind) else 1.0,
    )


def negation() -> Transducer:
    return Transducer(
        within(REACH, NEGATION), STAY, lambda before, x, behind: NEGATED if weighs(x) and before else 1.0
    )


def reported_speech() -> Transducer:
    return Transducer(
        seen(REPORT), STAY, lambda before, x, behind: REPORTED if weighs(x) and before else 1.0
    )


def side_by_side(left: Steps, right: Steps) -> Steps:
    """Both automata on the same symbols; states are pairs, numbered from the pair of both starts."""
    pairs = sorted({(a, b) for a, _ in left for b, _ in right})
    number = {pair: i for i, pair in enumerate(pairs)}
    return {
        (number[a, b], symbol): number[left[a, symbol], right[b, symbol]]
        for a, b in pairs
        for symbol in SYMBOLS
    }


def compose(left: Transducer, right: Transducer) -> Transducer:
    """The transducer that runs both; factors multiply."""
    before = sorted({(a, b) for a, _ in left.onward for b, _ in right.onward})
    behind = sorted({(a, b) for a, _ in left.back for b, _ in right.back})
    factor = {
        (i, symbol, j): left.factor(a, symbol, c) * right.factor(b, symbol, d)
        for i, (a, b) in enumerate(before)
        for j, (c, d) in enumerate(behind)
        for symbol in SYMBOLS
    }
    return Transducer(
        side_by_side(left.onward, right.onward),
        side_by_side(left.back, right.back),
        lambda before, symbol, behind: factor[before, symbol, behind],
    )


def table(steps: Steps) -> list[list[int]]:
    return [[steps[state, x] for x in SYMBOLS] for state in range(len(steps) // len(SYMBOLS))]


def machine() -> tuple[list[list[int]], list[list[int]], Callable[[int, int, int], float]]:
    """The composition of all five: tables ``state x symbol`` onward and back, and the factor."""
    parts = [insult(), threat(), target(), negation(), reported_speech()]
    whole = reduce(compose, parts)
    return table(whole.onward), table(whole.back), whole.factor


@dataclass
class Model:
    """Weights of whole words and of beginnings, and the curve from evidence to score."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    offset: float = -2.0
    slope: float = 1.5


class Symbols(dict):
    """Token -> (symbol, weight, whether a clause ends after it, the word if it has a weight)."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.shared: dict[tuple, tuple] = {}

    def __missing__(self, token: str) -> tuple[int, float, bool, str]:
        word = EDGES.sub("", token)
        symbol, weight = OTHER, 0.0
        weights = [self.model.words.get(word, 0.0)]
        weights += [self.model.beginnings.get(word[:n], 0.0) for n in BEGINNINGS if len(word) >= n]
        plain = word.replace("\u2019", "'")
        if max(weights) > 0:
            symbol, weight = THREAT if word in THREATS else INSULT, max(weights)
        elif plain in TARGETS:
            symbol = TARGET
        elif plain in SELVES or plain.startswith("j'"):
            symbol = SELF
        elif plain in NEGATIONS or plain.endswith("n't") or plain.startswith("n'"):
            symbol = NEGATION
        elif plain in SPEECH:
            symbol = REPORT
        entry = (symbol, weight, bool(CLAUSE_END.search(token)), word if weight else "")
        entry = self.shared.setdefault(entry, entry)
        if len(self) >= REMEMBERED:
            self.clear()
            self.shared.clear()
        self[token] = entry
        return entry


def clause_scorer(model: Model) -> Callable[[str], tuple[float, int]]:
    """Text -> the sum of its distinct matching clauses' weights, and their number."""
    symbols = Symbols(model)
    onward, back, factor = machine()

    def weigh(clause: list[tuple]) -> float:
        behind, state = [], 0
        for symbol, _, _, _ in reversed(clause):
            behind.append(state)
            state = back[state][symbol]
        total, state = 0.0, 0
        for symbol, weight, _, _ in clause:
            after = behind.pop()
            if weight:
                total += weight * factor(state, symbol, after)
            state = onward[state][symbol]
        return total

    def score(text: str) -> tuple[float, int]:
        tokens = list(map(symbols.__getitem__, text.lower().replace("\n", " . ").split()))
        if not any([weight for _, weight, _, _ in tokens]):
            return 0.0, 0
        matched: dict[tuple, float] = {}
        begin, last = 0, len(tokens) - 1
        for end, (_, _, ends, _) in enumerate(tokens):
            if ends or end == last:
                clause = tokens[begin : end + 1]
                begin = end + 1
                if words := tuple([word for _, weight, _, word in clause if weight]):
                    # Clauses that match with the same words count once, however often repeated.
                    matched[words] = max(weigh(clause), matched.get(words, 0.0))
        return sum(matched.values()), len(matched)

    return score


def features(text: str) -> set[str]:
    """Distinct words, marked by a last ``$``, and beginnings of longer words."""
    words = {EDGES.sub("", token) for token in set(text.lower().split())}
    out = {word + "$" for word in words if word}
    for n in BEGINNINGS:
        out |= {word[:n] for word in words if len(word) > n}
    return out


def counts(side: Counter, toxic: int) -> pa.RecordBatch:
    numbers, none = list(side.values()), [0] * len(side)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(side), pa.string()),
            pa.array(numbers if toxic else none, pa.int64()),
            pa.array(none if toxic else numbers, pa.int64()),
        ],
        ["feature", "toxic", "clean"],
    )


def counted(sample: DataFrame) -> DataFrame:
    """``feature, toxic, clean``: documents of each kind that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[Counter, Counter] = (Counter(), Counter())
        for part in portions(batches, "text"):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                sides[toxic].update(features(text))
            for toxic, side in enumerate(sides):
                if len(side) >= COUNTED:
                    yield counts(side, toxic)
                    side.clear()
        for toxic, side in enumerate(sides):
            yield counts(side, toxic)

    partial = sample.select("text", "toxic").mapInArrow(run, "feature string, toxic long, clean long")
    return partial.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def without_short_twins(entries: DataFrame) -> DataFrame:
    """``feature, toxic, clean`` without beginnings that say no more than a longer entry, and so
    would only reach too far: those with its counts."""
    shorter = F.filter(
        F.array(*[F.substring("feature", 1, n) for n in BEGINNINGS]),
        lambda beginning: F.length(beginning) < F.length("feature"),
    )
    same = ["feature", "toxic", "clean"]
    covered = entries.select(F.explode(F.array_distinct(shorter)).alias("feature"), "toxic", "clean")
    return entries.join(covered.distinct(), same, "left_anti")


def learn_lexicon(sample: DataFrame) -> Model:
    """Words and beginnings whose share of toxic documents chance explains less than once among
    all that were counted, however many; weighed by their log odds. The words of the lists are always in."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    given = {word: GIVEN for word in (*INSULTS, *THREATS)}
    if not toxic or not clean:
        return Model(words=given)
    rate = toxic / (toxic + clean)
    table = stored(counted(sample), "toxic-features")
    p, n = F.col("toxic"), F.col("clean")
    gain = p * F.log(p / ((p + n) * rate)) + F.when(
        n > 0, n * F.log(n / ((p + n) * (1 - rate)))
    ).otherwise(0.0)
    least = CAUTION * math.log(max(table.count(), 2))
    listed = F.col("feature").isin([word + "$" for word in given])
    strong = table.filter((p > (p + n) * rate) & (gain >= least))
    chosen = without_short_twins(stored(strong.select("feature", p, n), "toxic-entries")).collect()
    model = Model(words=given)
    for row in chosen + table.filter(listed & (p + n >= 5)).collect():
        odds = (row["toxic"] + 0.5) / (toxic + 1) / ((row["clean"] + 0.5) / (clean + 1))
        name, weight = row["feature"], max(0.0, math.log(odds))
        if name.endswith("$"):
            model.words[name[:-1]] = weight
        else:
            model.beginnings[name] = weight
    return model


def fit_curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic curve over ``log(1 + evidence)``, by Newton's steps with a
    weak prior; the defaults where only one kind of label is known."""
    if not toxic.any() or toxic.all():
        return Model.offset, Model.slope
    x = np.stack([np.ones(len(evidence)), np.log1p(evidence)], axis=1)
    prior = np.array([Model.offset, Model.slope])
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + 0.1 * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 2.0 / np.abs(step).max())
    return float(w[0]), float(max(w[1], 0.0))


def evidence_of(model: Model):
    """A column function: the evidence in a text, null as 0."""

    @F.pandas_udf("double")
    def evidence(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = clause_scorer(model)
        for part in parts:
            yield pd.Series([score(t)[0] if t else 0.0 for t in part], dtype="float64")

    return evidence


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents outside the held-out fold, ``SAMPLE`` rows at most.

    ``docs`` are ``doc_id, text``. Rows without an id or a label train nothing; an id with several
    labels is toxic if one says so.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.filter(fold(F.col("doc_id"), FOLDS) != 0)
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    chosen = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "toxic-sample")
    sample = docs.join(F.broadcast(chosen), "doc_id")
    # Near copies would count a rare word several times; of those with the same sketch the first stays.
    words = F.transform(F.split("text", r"\s+"), lambda word: F.xxhash64(word))
    turned = F.transform(words, lambda word: F.xxhash64(word))
    sketch = F.struct(F.array_min(words), F.array_min(turned), "toxic")
    first = F.min(F.struct("doc_id", "text", "toxic")).alias("first")
    sample = sample.groupBy(F.xxhash64(sketch).alias("sketch")).agg(first)
    sample = stored(sample.select("first.text", "first.toxic"), "toxic-texts")
    model = learn_lexicon(sample)
    pairs = sample.select(evidence_of(model)("text").alias("evidence"), "toxic").toPandas()
    model.offset, model.slope = fit_curve(
        pairs["evidence"].to_numpy(float), pairs["toxic"].to_numpy(float)
    )
    return model


def score_column(model: Model, text: str = "text"):
    evidence = evidence_of(model)(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    return 1 / (1 + F.exp(-(F.lit(model.offset) + F.lit(model.slope) * F.log1p(evidence))))


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null and empty texts have no evidence and get the curve's lowest score. Only the text enters a
    score. Repeated rows and null ids get a row each; a null id is not held out. Without labels of
    both kinds the word lists and default curve are used. Other columns play no part.
    """
    rows = texts(docs, key, text)
    model = train(rows, labels)
    out = rows.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
        score_column(model).alias("score"),
    )
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, all their columns, that are not predicted to be toxic."""
    model = train(texts(docs, key, text), labels)
    marked = docs.withColumn("__score", score_column(model, text))
    return marked.filter("__score < 0.5").drop("__score")
