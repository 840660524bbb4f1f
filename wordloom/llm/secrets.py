"""Secrets in texts: fixed patterns, and a linear-chain conditional random field.

A text is cut at blanks into chunks and these into tokens. A token is the beginning of a secret, its
inside, or outside. Only a token with a digit or of some length can begin one, and an inside token
follows without a blank, so every other token is outside and the chain falls into the chunks that
hold such a token: decoding those one by one with Viterbi's algorithm is decoding the whole text.
Scores come from the shape of a token, the words before and behind it, and features of the text.

The field is fitted by gradient ascent on the likelihood of a bounded sample of chunks, labelled by
the fixed patterns: those of the texts, and lines of the same grammar, looser ones and harmless
ones that are planted between the words of sampled texts, drawn by a hash.

Defined results: null texts count as empty and hold nothing; empty texts give a row without spans;
repeated rows are scanned one by one; a table without texts is scanned by the patterns alone.
"""

from __future__ import annotations

import random
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

# The base patterns, on texts whose letters A-Z are lower-cased for the first.
ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "field")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# A chunk between blanks with a digit or a long run; its tokens; what can begin a secret.
CHUNK = re.compile(r"(?<!\S)(?=\S*?(?:\d|[\w+/.=-]{16}))\S++")
TOKEN = re.compile(r"[\w+/-]+(?:\.[\w+/-]+)*(?:(?<=[\w+/-]{16})={1,2})?|[^\w\s]")
WORD = re.compile(r"[^\W\d_]+(?:_[^\W\d_]+)*|[^\w\s]")
BEGINS = re.compile(r"\d|.{16}", re.S)

# Characters around a chunk that are looked at, and words among them.
BEFORE, AFTER, WORDS = 64, 32, 4
# Bounds of the training: documents by smallest hash, then examples of each kind.
SAMPLE_DOCS, SAMPLE = 20_000, 4_000
# Tokens of a training example, steps of the ascent and weight of the penalty.
LONGEST, STEPS, PENALTY = 16, 80, 1e-4
OUT, BEGIN, INSIDE = 0, 1, 2
# What is ruled out, and what stands for it where likelihoods of short chains are summed.
NEVER, RARE = float("-inf"), -1e4

SPANS = "doc_id long, spans array<struct<kind:string,start:long,stop:long>>"
EXAMPLES = "kind string, at long, features string, begins array<boolean>, tags array<int>"


def base_spans(text: str, chunks: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns that are long enough, in the order of their start and kind."""
    found = []
    for m in ASSIGN.finditer(text.translate(LOWER)):
        if m.end(1) - m.start(1) >= LEAST["assign"]:
            found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]
        ]
    # A run long enough lies in a chunk.
    for first, last in chunks_of(text) if chunks is None else chunks:
        if last - first >= LEAST["hex"]:
            found += [
                (m.start(), 2, m.end())
                for m in HEX.finditer(text, first, last)
                if m.end() - m.start() >= LEAST["hex"]
            ]
    return [(KINDS[kind], first, last) for first, kind, last in sorted(found)]


def chunks_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CHUNK.finditer(text)]


def bucket(value: float, bounds: tuple) -> int:
    return sum(value >= b for b in bounds)


def letters_of(token: str) -> str:
    """Which characters a token is made of."""
    core = token.strip("=").translate({ord(c): None for c in "+/_.-"})
    if not core:
        return "mark"
    if core.isdigit():
        return "digits"
    if core.isalpha():
        if core.islower() or core.isupper():
            return "lower" if core.islower() else "upper"
        return "title" if core[1:].islower() else "letters"
    if all(c in "0123456789abcdef" for c in core):
        return "hex"
    if core.islower():
        return "low-digits"
    if core.isupper():
        return "up-digits"
    return "mixed"


def own_features(token: str) -> list[str]:
    """The shape of a token."""
    kind = letters_of(token)
    size = bucket(len(token), (2, 3, 5, 8, 12, 16, 20, 24, 32, 40, 41, 64, 65))
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    turns = bucket(turns, (1, 2, 3, 5, 9))
    distinct = bucket(len(set(token)), (2, 5, 8, 11, 14))
    marks = "".join(c for c in "+/_.-=" if c in token)
    return [
        f"kind {kind}", f"size {size}", f"first {token[:1] if token[:1] in '+/_-' else ''}", f"turns {turns}", f"distinct {distinct}", f"marks {marks}",
        f"kind {kind} size {size}", f"kind {kind} turns {turns}", f"long {len(token) >= 8} turns {turns >= 2}",
    ]


def file_features(text: str) -> list[str]:
    """Features of the whole text."""
    return [
        f"file size {bucket(len(text), (200, 2000, 20000))}",
        f"file signs {bucket(text.count('='), (1, 4, 16))}",
        f"file lines {bucket(text.count(chr(10)), (1, 10, 100))}",
    ]


def words_around(text: str, first: int, last: int) -> tuple[list[str], list[str]]:
    """The words before a chunk, the nearest first, and those behind it."""
    before = text[max(0, first - BEFORE) : first]
    if first > BEFORE and not before[:1].isspace():
        # The first word may be cut.
        before = re.sub(r"^\S+", "", before)
    near = [w.lower() for w in WORD.findall(before)[-WORDS:]][::-1]
    behind = [w.lower() for w in WORD.findall(text[last : last + AFTER])[:1]]
    return near, behind


def chain(text: str, first: int, last: int, of_file: list[str]):
    """Places, features and possible beginnings of the tokens of a chunk."""
    near, behind = words_around(text, first, last)
    spans = [m.span() for m in TOKEN.finditer(text, first, last)]
    tokens = [text[a:b] for a, b in spans]
    features, earlier = [], near
    for i, token in enumerate(tokens):
        ahead = tokens[i + 1].lower() if i + 1 < len(tokens) else behind[0] if behind else "end"
        words = [w for w in earlier if w[:1].isalpha()]
        rows = ["any", f"place {min(i, 3)}", *own_features(token), *of_file]
        rows.append(f"before {earlier[0] if earlier else 'start'}")
        rows.append(f"behind {ahead if len(ahead) < 16 else 'long'}")
        parts = [part for w in words for part in w.split("_")]
        rows += dict.fromkeys(f"near {w}" for w in words + parts)
        features.append(rows)
        word = token.lower() if len(token) < 16 else "long"
        earlier = [word, *earlier][:WORDS]
    return spans, features, [bool(BEGINS.search(t)) for t in tokens]


def tags_of(spans: list[tuple[int, int]], secrets: list[tuple[int, int]]) -> list[int]:
    """The tag of each token, given the secret ranges of a text."""
    out = []
    for a, b in spans:
        inside = next((s for s in secrets if s[0] < b and a < s[1]), None)
        if inside is None:
            out.append(OUT)
        else:
            goes_on = out and out[-1] != OUT and spans[len(out) - 1][1] > inside[0]
            out.append(INSIDE if goes_on else BEGIN)
    return out


# Planted lines: the names of the fixed patterns, looser words between name and value, and values
# of several alphabets and lengths.
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "auth", "bearer", "credential")
BETWEEN = (" = ", "=", ": ", ":", ' = "', '="', "='", ' : "', " is ", " => ", " ", " -> ")
ALPHABETS = (
    ("0123456789abcdef", (16, 24, 32, 40, 64)),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", (16, 20, 24)),
    ("abcdefghijklmnopqrstuvwxyz0123456789", (12, 16, 24, 32)),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", (12, 20, 32, 40)),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", (20, 32, 40)),
)

# Planted lines that hold no secret; # stands for a drawn digit, ? for a word of the text.
HARMLESS = (
    "https://www.?.org/?/#####/?.html", "http://?.com/?_?-##?id=####", "####-##-## ##:##:##", "+## ### #######",
    "?/?/?.py", "/var/?/?-##.log", "v##.#.###", "?_?_?_?", "#### #### #### ####", "?@?.com", "##.###,##",
)


def harmless(text: str, seed: int) -> str:
    """A harmless line made of words of the text."""
    draw = random.Random(seed)
    words = re.findall(r"[^\W\d_]+", text[:4000]) or ["word"]
    line = re.sub("#", lambda _: str(draw.randrange(10)), draw.choice(HARMLESS))
    return re.sub(r"\?(?!id)", lambda _: draw.choice(words), line)


def planted(text: str, seed: int) -> tuple[str, tuple[int, int]]:
    """The text with a line of the grammar between two of its words, and the place of its value."""
    draw = random.Random(seed)
    name, between = draw.choice(NAMES), draw.choice(BETWEEN)
    name = draw.choice((name, name.upper(), name.title()))
    alphabet, sizes = draw.choice(ALPHABETS)
    value = "".join(draw.choice(alphabet) for _ in range(draw.choice(sizes)))
    if alphabet[0] == "A" and len(alphabet) == 36 and draw.random() < 0.5:
        value, name = "AKIA" + value[4:], draw.choice(("", "key"))
    closing = between.strip()[-1:] if between.strip()[-1:] in ("'", '"') else ""
    blanks = [m.start() for m in re.finditer(r"\s", text[:4000])] or [len(text)]
    at = draw.choice(blanks)
    before = f"{text[:at]} {name}{between}"
    return f"{before}{value}{closing} {text[at:]}", (len(before), len(before) + len(value))


def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of the sampled texts with features and tags."""
    schema = pa.schema(
        [("kind", pa.string()), ("at", pa.int64()), ("features", pa.string()),
         ("begins", pa.list_(pa.bool_())), ("tags", pa.list_(pa.int32()))]
    )

    def rows_of(key: int, text: str) -> Iterator[dict]:
        def row(kind: str, order: int, text: str, place: tuple[int, int], secrets: list) -> dict:
            spans, features, begins = chain(text, *place, file_features(text))
            some = slice(0, LONGEST)
            tags = tags_of(spans, secrets)[some]
            return {
                "kind": kind,
                "at": zlib.crc32(b"%d:%d" % (key, order)),
                # Names hold no blank but spaces.
                "features": "\n".join("\t".join(f) for f in features[some]),
                "begins": begins[some],
                "tags": [OUT if t == BEGIN and not b else t for t, b in zip(tags, begins[some])],
            }

        chunks = chunks_of(text)
        values = [m.span(1) for m in ASSIGN.finditer(text.translate(LOWER)) if len(m[1]) >= LEAST["assign"]]
        values += [(a, b) for kind, a, b in base_spans(text, chunks) if kind != "assign"]
        for i, place in enumerate(chunks):
            holds = any(s[0] < place[1] and place[0] < s[1] for s in values)
            # Long words are rare beside numbers.
            if holds or text[place[0] : place[1]].isalpha() or zlib.crc32(b"%d.%d" % (key, i)) % 8 == 0:
                yield row("secret" if holds else "other", i, text, place, values)
        changed, value = planted(text, key)
        for place in chunks_of(changed):
            if place[0] < value[1] and value[0] < place[1]:
                yield row("planted", -1, changed, place, [value])
        line = harmless(text, key)
        changed = f"{text[:BEFORE]} {line} {text[BEFORE : 2 * BEFORE]}"
        for place in chunks_of(changed):
            if place[0] <= BEFORE + len(line) and place[1] > min(len(text), BEFORE):
                yield row("harmless", -2, changed, place, [])

    for batch in batches:
        out = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            text = text.as_py() or ""
            out += rows_of(zlib.crc32(str(doc_id).encode()), text)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)


class Field:
    """Weights of features and of steps between tags."""

    def __init__(self, weights: dict[str, tuple[float, float, float]], steps: list[list[float]]):
        self.weights, self.steps = weights, steps

    def scores(self, features: list[list[str]], begins: list[bool]) -> list[list[float]]:
        out = []
        for row, begin in zip(features, begins):
            total = [0.0, 0.0, 0.0]
            for name in row:
                w = self.weights.get(name)
                if w is not None:
                    total[0] += w[0]
                    total[1] += w[1]
                    total[2] += w[2]
            if not begin:
                total[BEGIN] = NEVER
            out.append(total)
        return out

    def decode(self, features: list[list[str]], begins: list[bool]) -> list[int]:
        """The best tags of a chain, by Viterbi's algorithm; outside stands before it."""
        best, ways = [0.0, NEVER, NEVER], []
        for here in self.scores(features, begins):
            way = [max(range(3), key=lambda s, t=t: best[s] + self.steps[s][t]) for t in range(3)]
            best = [best[way[t]] + self.steps[way[t]][t] + here[t] for t in range(3)]
            ways.append(way)
        tag = max(range(3), key=best.__getitem__)
        out = []
        for way in reversed(ways):
            out.append(tag)
            tag = way[tag]
        return out[::-1]


class Fit:
    """Likelihood of tagged chains and its gradient, all chains of a step at once."""

    def __init__(self, names: dict[str, int], rows: list[dict]):
        self.names = names
        longest = max(len(r["tags"]) for r in rows)
        self.shape = len(rows), longest
        cells, ids = [], []
        self.tags = np.full(self.shape, -1)
        self.bar = np.zeros((*self.shape, 3))
        for i, r in enumerate(rows):
            for j, f in enumerate(r["features"]):
                known = [names[n] for n in f if n in names]
                cells += [i * longest + j] * len(known)
                ids += known
                self.tags[i, j] = r["tags"][j]
                if not r["begins"][j]:
                    self.bar[i, j, BEGIN] = RARE
        self.cells, self.ids = np.array(cells, int), np.array(ids, int)
        self.live = self.tags >= 0

    def gradient(self, weights: np.ndarray, steps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood, and its slope for the weights and the steps."""
        n, longest = self.shape
        here = np.zeros((n * longest, 3))
        for t in range(3):
            here[:, t] = np.bincount(self.cells, weights[self.ids, t], n * longest)
        here = here.reshape(n, longest, 3) + self.bar
        fixed = steps.copy()
        fixed[OUT, INSIDE] = RARE
        total = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
        forward = np.full((n, longest + 1, 3), RARE)
        forward[:, 0, OUT] = 0.0
        for j in range(longest):
            step = total(forward[:, j, :, None] + fixed[None], 1) + here[:, j]
            forward[:, j + 1] = np.where(self.live[:, j, None], step, forward[:, j])
        backward = np.zeros((n, longest + 1, 3))
        for j in range(longest - 1, -1, -1):
            step = total(fixed[None] + (here[:, j] + backward[:, j + 1])[:, None, :], 2)
            backward[:, j] = np.where(self.live[:, j, None], step, backward[:, j + 1])
        whole = total(forward[:, longest], 1)
        likely, slope, step_slope = -whole.sum(), np.zeros_like(here), np.zeros((3, 3))
        row = np.arange(n)
        before = np.zeros(n, int)
        for j in range(longest):
            live = self.live[:, j]
            both = forward[:, j, :, None] + fixed[None] + (here[:, j] + backward[:, j + 1])[:, None, :]
            chance = np.exp(both - whole[:, None, None]) * live[:, None, None]
            tag = np.where(live, self.tags[:, j], OUT)
            likely += (fixed[before, tag] + here[row, j, tag])[live].sum()
            step_slope -= chance.sum(axis=0)
            np.add.at(step_slope, (before[live], tag[live]), 1.0)
            slope[:, j] -= chance.sum(axis=1)
            slope[row[live], j, tag[live]] += 1.0
            before = np.where(live, tag, before)
        step_slope[OUT, INSIDE] = 0.0
        flat = slope.reshape(-1, 3)
        out = np.stack(
            [np.bincount(self.ids, flat[self.cells, t], len(self.names)) for t in range(3)], axis=1
        )
        return likely, out, step_slope


def fit(rows: list[dict]) -> Field | None:
    """A field for tagged chains; none for no chains."""
    rows = [r for r in rows if r["tags"]]
    if not rows:
        return None
    seen = Counter(name for r in rows for f in r["features"] for name in f)
    names = {name: i for i, name in enumerate(sorted(n for n, c in seen.items() if c >= 2))}
    # Chains of about equal length together.
    classes: dict[int, list[dict]] = {}
    for r in rows:
        classes.setdefault((len(r["tags"]) - 1).bit_length(), []).append(r)
    parts = [Fit(names, some) for some in classes.values()]
    weights, steps = np.zeros((len(names), 3)), np.zeros((3, 3))
    moments = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros_like(steps), np.zeros_like(steps)]]
    for k in range(1, STEPS + 1):
        slopes = [part.gradient(weights, steps) for part in parts]
        slope = sum(s[1] for s in slopes) / len(rows)
        step_slope = sum(s[2] for s in slopes) / len(rows)
        for value, up, (mean, square) in zip((weights, steps), (slope, step_slope), moments):
            up = up - PENALTY * value
            mean += 0.1 * (up - mean)
            square += 0.01 * (up * up - square)
            value += 0.1 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    steps[OUT, INSIDE] = NEVER
    return Field(
        {name: tuple(weights[i].tolist()) for name, i in names.items()}, steps.tolist()
    )


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def learned(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample: int = SAMPLE) -> Field | None:
    """A field for the texts, from the documents with the smallest hashes of their ids.

    Both bounds are on rows that reach the driver or a task; only ids are read to find the edge.
    """
    rows = rows_of(docs).filter("text IS NOT NULL")
    order = F.xxhash64("doc_id")
    smallest = rows.select(order.alias("h")).orderBy("h").limit(sample_docs)
    edge = smallest.agg(F.max("h").alias("h")).first().h
    if edge is None:
        return None
    found = stored(rows.filter(order <= edge).mapInArrow(examples, EXAMPLES), "tagged-chunks")
    chosen = []
    for kind in ("secret", "other", "planted", "harmless"):
        some = found.filter(F.col("kind") == kind).orderBy("at", "features").limit(sample)
        chosen += [r.asDict() for r in some.collect()]
    for r in chosen:
        r["features"] = [line.split("\t") for line in r["features"].split("\n")]
    return fit(chosen)


def field_spans(text: str, field: Field, chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that the field takes for secrets."""
    out: list[tuple[int, int]] = []
    of_file = file_features(text) if chunks else []
    for first, last in chunks:
        spans, features, begins = chain(text, first, last, of_file)
        if not any(begins):
            continue
        for (a, b), tag in zip(spans, field.decode(features, begins)):
            if tag == BEGIN:
                out.append((a, b))
            elif tag == INSIDE:
                out[-1] = (out[-1][0], b)
    return out


def all_spans(text: str, field: Field | None) -> list[tuple[str, int, int]]:
    """The base spans, and those of the field that meet none of them."""
    chunks = chunks_of(text)
    base = base_spans(text, chunks)
    if field is None:
        return base
    extra = [
        ("field", a, b)
        for a, b in field_spans(text, field, chunks)
        if not any(first < b and a < last for _, first, last in base)
    ]
    return sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, spans``: kind, start and end of each secret, in code points."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            found = []
            for text in batch["text"]:
                spans = all_spans(text.as_py() or "", field)
                found.append([{"kind": k, "start": a, "stop": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, kind)], names=["doc_id", "spans"]
            )

    return rows_of(docs).mapInArrow(batches_of, SPANS)


def secrets(docs: DataFrame) -> DataFrame:
    """Every text scanned with a field that is learned from a sample of them."""
    return scan(docs, learned(docs))


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    base = F.filter("spans", lambda s: s["kind"] != "field")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
