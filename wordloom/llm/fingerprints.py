"""Document fingerprints from prefix polynomial hashes.

``prefix[i]`` is the sum of ``c[j] * base**j`` over the first i code points, modulo a prime. Any
two spans compare in constant time through their prefixes, and the longest common extension of two
positions is found by binary search. A fingerprint keeps the length, the hash of the whole text and
the hashes of cells, short spans that cover the text: they are counted anew from every place that
the text around it marks, so that equal spans have equal cells wherever they stand.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.bpe import portions
from wordloom.llm.common import texts, worker_cache
from wordloom.session import shuffle_width

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Two primes below 2**31 with a base for each: products fit 64 bits, sums of 2**32 terms too.
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003_571, 998_244_757)
# The inverses of the bases: they bring a span's hash to the start of its text.
INVERSES = tuple(pow(base, -1, modulus) for base, modulus in zip(BASES, MODULI))
# Code points of a cell, at most, from fine to coarse. A fingerprint starts with the first that cuts
# the text into about ``CELLS``, or with the last, and has all coarser ones too: those of short
# texts stay small, those of long texts grow with them, and any two have the last in common.
CELL_SIZES = (4, 8, 16, 32, 64)
CELLS = 32
# A mark stands where the hash of so many code points, or of a cell's where that is less, is above
# all others within twice the cell.
WINDOW = 16
MIXER = np.uint64(0x9E3779B97F4A7C15)
# Ranges of ids that a task holds on average; each range is read in order.
RANGES_PER_TASK = 3

# A cell in a fingerprint, as ten hexadecimal digits.
CELL_KIND = np.dtype([("hash", ">u4"), ("length", "u1")])

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, "
    "common_edited long, common_next long"
)


def powers(n: int, which: int, bases: tuple[int, ...] = BASES) -> np.ndarray:
    """``base**0 .. base**(n-1)``; kept by the worker process and doubled when needed."""
    cache = worker_cache("fingerprint-powers")
    known = cache.get(bases[which])
    if known is None:
        known = np.ones(1, np.uint64)
    modulus = np.uint64(MODULI[which])
    while len(known) < n:
        step = np.uint64(pow(bases[which], len(known), MODULI[which]))
        known = np.concatenate([known, known * step % modulus])
    if len(known) <= 1 << 21:
        cache[bases[which]] = known
    return known[:n]


def marks(points: np.ndarray, window: int, reach: int) -> np.ndarray:
    """Places that the text marks itself, more than the reach apart, rising.

    A mark depends on the code points within reach and window of it only. Where a text repeats
    itself within the reach, no place stands out and there is none.
    """
    n = len(points) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # Hashes of windows by doubling; sums overflow, which is the modulus.
    hashes, width, factor = (points + np.uint64(1)) * MIXER, 1, int(MIXER)
    hashes ^= hashes >> np.uint64(29)
    while width < window:
        hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    hashes ^= hashes >> np.uint64(32)
    hashes *= MIXER
    padded = np.zeros(n + 2 * reach, np.uint64)
    padded[reach : reach + n] = hashes
    # most[i] is the maximum of the next hashes, as many as the reach, from padded[i] on.
    most, width = padded, 1
    while width < reach:
        most = np.maximum(most[:-width], most[width:])
        width *= 2
    above = (hashes > most[:n]) & (hashes > most[reach + 1 : reach + 1 + n])
    return np.flatnonzero(above)


def cell_bounds(points: np.ndarray, cell: int) -> np.ndarray:
    """Where cells begin, and the end: every ``cell`` places from the start and from each mark."""
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    starts = np.unique(np.append(marks(points, min(WINDOW, cell), 2 * cell), 0))
    cells = -(-np.diff(np.append(starts, n)) // cell)
    first = np.repeat(np.cumsum(cells) - cells, cells)
    begins = np.repeat(starts, cells) + (np.arange(int(cells.sum())) - first) * cell
    return np.append(begins, n)


def cell_sizes(n: int) -> tuple[int, ...]:
    """The sizes of cells in the fingerprint of a text of n code points."""
    finest = next((i for i, cell in enumerate(CELL_SIZES) if n <= CELLS * cell), -1)
    return CELL_SIZES[finest:]


class Prefixes:
    """Prefix hashes of a text under both moduli."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.bounds = [cell_bounds(points, cell) for cell in cell_sizes(self.n)]
        self.made: str | None = None
        self.sums = []
        for which, modulus in enumerate(MODULI):
            terms = (points + np.uint64(1)) * powers(self.n, which) % np.uint64(modulus)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            sums %= np.uint64(modulus)
            self.sums.append(sums)

    def same(self, i: int, other: Prefixes, j: int, length: int) -> bool:
        """Whether the spans of this length at i, and at j of the other text, are equal."""
        for which, modulus in enumerate(MODULI):
            a, b = self.sums[which], other.sums[which]
            mine = (int(a[i + length]) - int(a[i])) * pow(BASES[which], j, modulus)
            theirs = (int(b[j + length]) - int(b[j])) * pow(BASES[which], i, modulus)
            if (mine - theirs) % modulus:
                return False
        return True

    def common(self, i: int, other: Prefixes, j: int) -> int:
        """Length of the longest equal spans that start at i and at j of the other text."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def cells(self, bounds: np.ndarray) -> str:
        """The spans' hashes under the first modulus, brought to the start, and their lengths."""
        modulus, sums = np.uint64(MODULI[0]), self.sums[0][bounds]
        hashes = (sums[1:] + modulus - sums[:-1]) % modulus
        cells = np.zeros(len(hashes), CELL_KIND)
        cells["hash"] = hashes * powers(self.n, 0, INVERSES)[bounds[:-1]] % modulus
        cells["length"] = np.diff(bounds)
        return cells.tobytes().hex()

    def fingerprint(self) -> str:
        if self.made is None:
            whole = "".join(f"{int(s[-1]):08x}" for s in self.sums)
            self.made = "-".join([f"{self.n:x}", whole, *map(self.cells, self.bounds)])
        return self.made


def counted_cells(cells: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells, hash and length in one number, and how often each is there."""
    found = np.frombuffer(bytes.fromhex(cells), CELL_KIND)
    return np.unique(found["hash"].astype(np.int64) * 256 + found["length"], return_counts=True)


def likeness(left: str, right: str) -> float:
    """Share of the longer text that lies in cells of both, wherever they stand; equal texts give 1.

    Cells are of the finest size that both have; one counts as often as both texts have it.
    """
    (n, whole, *sizes), (m, other, *other_sizes) = left.split("-"), right.split("-")
    if (n, whole) == (m, other):
        return 1.0
    common = min(len(sizes), len(other_sizes))
    cells, counts = counted_cells(sizes[-common])
    other_cells, other_counts = counted_cells(other_sizes[-common])
    both, i, j = np.intersect1d(cells, other_cells, assume_unique=True, return_indices=True)
    same = int((np.minimum(counts[i], other_counts[j]) * (both % 256)).sum())
    return min(1.0, same / max(int(n, 16), int(m, 16), 1))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the start of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compare(doc_id: int | None, text: str, prefixes: Prefixes, after: tuple) -> tuple:
    _, following, next_prefixes = after
    changed = edited(text, following)
    changed_prefixes = Prefixes(code_points(changed))
    mine, theirs = prefixes.fingerprint(), changed_prefixes.fingerprint()
    return (
        doc_id,
        prefixes.n,
        hashlib.sha256(changed.encode()).hexdigest(),
        mine,
        theirs,
        likeness(mine, theirs),
        likeness(mine, next_prefixes.fingerprint()),
        prefixes.common(0, changed_prefixes, 0),
        prefixes.common(0, next_prefixes, 0),
    )


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text"):
            made = [Prefixes(code_points(t)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([p.n for p in made], pa.int64()),
                    pa.array([p.fingerprint() for p in made]),
                ],
                ["doc_id", "n_chars", "fingerprint"],
            )

    schema = "doc_id long, n_chars long, fingerprint string"
    return texts(docs, key, text).mapInArrow(run, schema)


def range_of(doc_id: Column, bounds: list[int]) -> Column:
    """The range of an id, larger ids first, null ids last."""
    if not bounds:
        return F.lit(0)
    above = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b >= doc_id)
    return F.when(doc_id.isNull(), F.lit(len(bounds))).otherwise(F.size(above))


def with_next(docs: DataFrame) -> DataFrame:
    """The rows cut into ranges of falling ids, each followed by the first row of the next range.

    Columns ``part`` (the range), ``ahead`` (a row that only follows) and the text. The ranges'
    first ids pass through the driver: as many as there are ranges, ids only.
    """
    width = shuffle_width(docs.sparkSession)
    shares = [i / (width * RANGES_PER_TASK) for i in range(1, width * RANGES_PER_TASK)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or []
    rows = docs.withColumn("part", range_of(F.col("doc_id"), sorted(set(found))))
    order = F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))), F.xxhash64("text"))
    tops = rows.select("part", order.alias("at")).groupBy("part").agg(F.max("at").alias("at"))
    firsts = sorted((r["part"], *r["at"]) for r in tops.collect())
    before = [(firsts[i - 1][0], *firsts[i][1:]) for i in range(len(firsts))]
    if not before:
        return rows.withColumn("ahead", F.lit(False))
    spark = docs.sparkSession
    heads = spark.createDataFrame(before, "target int, head long, head_hash long")
    ahead = rows.withColumn("at", order).join(
        F.broadcast(heads),
        (F.col("at").getField("col1") == F.col("head"))
        & (F.col("at").getField("col2") == F.col("head_hash")),
    )
    ahead = ahead.select("doc_id", "text", F.col("target").alias("part"), F.lit(True).alias("ahead"))
    return rows.withColumn("ahead", F.lit(False)).unionByName(ahead)


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited form, and their likeness, in one pass over ranges.

    The next document is the one with the next smaller id; after the last comes the first. Equal
    ids follow each other by a hash of the text, null ids come last, null texts are empty, a lone
    document is its own next, an empty table gives no rows. Texts are shuffled once, by ranges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for part in portions(batches, "text"):
            out = []
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                doc_id, value, number, ahead = row
                if ahead and waiting is None:
                    continue
                here = (doc_id, value, Prefixes(code_points(value)))
                if waiting is not None and waiting[0] == number:
                    mine = waiting[1]
                    out.append(compare(mine[0], mine[1], mine[2], here))
                waiting = None if ahead else (number, here)
            if out:
                columns = [list(c) for c in zip(*out, strict=True)]
                kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [field.split()[0] for field in SCHEMA.split(", ")],
                )

    rows = with_next(texts(docs, key, text))
    rows = rows.select("doc_id", "text", "part", "ahead").repartition(
        shuffle_width(docs.sparkSession), "part"
    )
    ordered = rows.sortWithinPartitions(
        "part", "ahead", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()
    )
    return ordered.mapInArrow(run, SCHEMA)
