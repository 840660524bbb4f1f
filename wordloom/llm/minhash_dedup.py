"""Near copies: SuperMinHash signatures, banding, verification on full sets, union-find.

Each shingle offers every signature position a rank plus a random fraction, in an order that is a
random permutation of the positions: the ranks of one shingle are correlated, which lowers the
variance of the estimate. Once a position holds a value, later ranks cannot beat it, so most
documents stop after one or two ranks.

Documents with equal sets are one class from the start. Classes that agree on a band are compared
on their full sets, first with a few members of their bucket each, which settles most of them;
then, inside buckets that still hold several components, all that differ are compared in blocks of
bounded size. No pair is left out within a bucket, and none between members of one component.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.bpe import portions
from wordloom.llm.common import stored, texts
from wordloom.llm.components import components
from wordloom.llm.exact_dedup import BITMAP_BITS, BITS_PER_ROW, MOST_BITMAPS, positions, probed
from wordloom.llm.shingles import mixed, shingle_set

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# 32 bands of 4 positions: a pair at similarity 0.8 shares no band once in 2 * 10**7 times.
POSITIONS, ROWS = 128, 4
BANDS = POSITIONS // ROWS
# Words of a shingle.
WIDTH = 5
# Linked from this many hundredths of similarity on.
PERCENT = 80
# Different heads that a class meets in the first comparison.
HEADS = 4
# Members, and members of smaller components, that a block of a bucket holds on average.
BLOCK = 256
# Comparisons with one head that a task gets at a time.
PER_HEAD = 512
# Shingles that are signed together.
TOGETHER = 50_000


def signatures(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SuperMinHash signatures of consecutive non-empty sets of shingle hashes."""
    m = POSITIONS
    values = np.full((len(sizes), m), np.inf)
    flat = values.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    hashes, orders = shingles, None
    for rank in range(m):
        random = mixed(hashes + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        fraction = (random >> np.uint64(32)) * 2.0**-32
        low = random & np.uint64(0xFFFFFFFF)
        chosen = rank + (low * np.uint64(m - rank) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            place = chosen
        else:
            each = np.arange(len(chosen))
            place = orders[each, chosen].astype(np.int64)
            orders[each, chosen] = orders[:, rank]
        np.minimum.at(flat, owner * m + place, rank + fraction)
        going = np.isinf(values).any(axis=1)[owner]
        if not going.any():
            break
        hashes, owner = hashes[going], owner[going]
        if rank == 0:
            orders = np.tile(np.arange(m, dtype=np.uint8), (len(hashes), 1))
            orders[np.arange(len(hashes)), chosen[going]] = 0
        else:
            orders = orders[going]
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band of a signature, different for equal values in different bands."""
    bits = values.view(np.uint64).reshape(len(values), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2])
    for i in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return out


def lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.fromiter(accumulate(map(len, arrays), initial=0), np.int32)
    joined = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, joined.view(np.int64))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, set_key, bands``: the size of a text's set, a key equal for equal sets only
    (128 bits of hash), and its bands, none for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in portions(batches, "text"):
            sets = [shingle_set(t, width) for t in part.column("text").to_pylist()]
            made: list[np.ndarray] = [np.empty(0, np.uint64)] * len(sets)
            group: list[int] = []
            for i, s in enumerate(sets):
                if len(s):
                    group.append(i)
                if group and (i + 1 == len(sets) or sum(len(sets[j]) for j in group) >= TOGETHER):
                    sizes = np.array([len(sets[j]) for j in group])
                    joined = np.concatenate([sets[j] for j in group])
                    for j, row in zip(group, bands(signatures(joined, sizes)), strict=True):
                        made[j] = row
                    group = []
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    lists(made),
                ],
                ["doc_id", "n", "set_key", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, n int, set_key binary, bands array<long>")


def likely(rows: DataFrame, wanted: DataFrame, key: str, out: str) -> DataFrame:
    """The rows with ``out``: false only if the key is not among the wanted ``doc_id``.

    Looks the key up in a broadcast filter of bounded size, so nothing is shuffled.
    """
    bits = min(MOST_BITMAPS, -(-max(wanted.count(), 1) * BITS_PER_ROW // BITMAP_BITS)) * BITMAP_BITS
    places = wanted.select(F.explode(F.array(*positions(F.col("doc_id"), bits))).alias("at"))
    bitmaps = places.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")
    )
    return probed(rows, key, stored(bitmaps, "near-filter"), bits, out)


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``doc_id, shingles`` of the wanted ids; only texts that are likely wanted are shuffled."""
    chosen = likely(docs, wanted, "doc_id", "likely").filter("likely")
    chosen = chosen.select("doc_id", "text").join(wanted, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text"):
            sets = [shingle_set(t, width) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists(sets)], ["doc_id", "shingles"])

    return chosen.mapInArrow(run, "doc_id long, shingles array<long>")


def near_sizes(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough.

    The set of an ``a`` travels to the set of its ``b``; a ``b`` with many pairs is spread over
    copies of its set, one for each ``PER_HEAD`` pairs.
    """
    mine = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("mine"))
    theirs = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("theirs"))
    copies = pairs.groupBy("b").agg(F.ceil(F.count("*") / PER_HEAD).cast("int").alias("copies"))
    copies = stored(copies, "near-copies")
    every = theirs.join(copies, "b").select(
        "b", "theirs", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    )
    spread = pairs.join(copies, "b").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int").alias("copy")
    )
    joined = spread.join(mine, "a").join(every, ["b", "copy"])
    shared = F.size(F.array_intersect("mine", "theirs"))
    union = F.size("mine") + F.size("theirs") - shared
    return joined.filter(shared * 100 >= union * PERCENT).select("a", "b")


def first_pairs(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Each class with the heads of its buckets: ``a`` a member, ``b`` the head."""
    met = rows.join(buckets.select("key", "head"), "key").filter(
        (F.col("doc_id") != F.col("head.doc_id")) & near_sizes(F.col("n"), F.col("head.n"))
    )
    return met.select(F.col("doc_id").alias("a"), F.col("head.doc_id").alias("b")).distinct()


def links_in_block(table: pa.Table) -> pa.Table:
    """Links between components inside one block of a bucket, as few as join them.

    ``small`` rows are members of smaller components; they are compared with all other rows. A
    pair counts in the first band that it shares only.
    """
    small = np.array(table.column("small").to_pylist(), bool)
    ids = table.column("doc_id").to_numpy()
    kinds = table.column("component").to_numpy()
    own = np.array(table.column("bands").to_pylist(), np.int64)
    band = int(table.column("band")[0].as_py())
    sets = [np.array(s, np.int64) for s in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(numbers.max() + 1, np.int32)
    joined = {k: k for k in set(kinds.tolist())}

    def root(k: int) -> int:
        while joined[k] != k:
            k = joined[k]
        return k

    found: list[tuple[int, int]] = []
    others = np.flatnonzero(~small)
    for i in np.flatnonzero(small):
        equal = own[others] == own[i]
        close = np.minimum(sizes[others], sizes[i]) * 100 >= np.maximum(sizes[others], sizes[i]) * PERCENT
        candidates = (kinds[others] != kinds[i]) & close & (equal.argmax(axis=1) == band)
        if not candidates.any():
            continue
        mine = numbers[starts[i] : starts[i] + sizes[i]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[numbers], starts)[others]
        mark[mine] = 0
        similar = shared * 100 >= (sizes[others] + sizes[i] - shared) * PERCENT
        for j in others[candidates & similar]:
            a, b = root(int(kinds[i])), root(int(kinds[j]))
            if a != b:
                joined[max(a, b)] = min(a, b)
                found.append((int(kinds[i]), int(kinds[j])))
    return pa.table(
        {"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())}
    )


def remaining_links(rows: DataFrame, labels: DataFrame, sets: DataFrame, sketch: DataFrame) -> DataFrame:
    """Links ``a, b`` between components that share a bucket, all of them compared, in blocks.

    A bucket's largest component needs no comparison within itself; the members of the others meet
    every member, in a grid of blocks of bounded size.
    """
    known = rows.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "key", "band", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    known = stored(known, "near-buckets")
    counted = known.groupBy("key", "component").agg(F.count("*").alias("members"))
    per_key = counted.groupBy("key").agg(
        F.sum("members").alias("members"),
        F.max(F.struct("members", "component")).alias("largest"),
        F.count("*").alias("components"),
    )
    # Two members alone have been compared already.
    mixed_buckets = per_key.filter("components > 1 AND members > 2").select(
        "key",
        F.col("largest.component").alias("main"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("columns"),
        F.ceil((F.col("members") - F.col("largest.members")) / BLOCK).cast("int").alias("lines"),
    )
    met = known.join(mixed_buckets, "key")
    line = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("lines")).cast("int")
    column = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.col("columns")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = met.select(
        "key", "band", "doc_id", "component", F.lit(False).alias("small"), column.alias("column"), every("lines").alias("line")
    )
    small = met.filter("component <> main").select(
        "key", "band", "doc_id", "component", F.lit(True).alias("small"), line.alias("line"), every("columns").alias("column")
    )
    full = sets.join(sketch.select("doc_id", "bands").dropDuplicates(["doc_id"]), "doc_id")
    grid = members.unionByName(small).join(full, "doc_id")
    return grid.groupBy("key", "line", "column").applyInArrow(links_in_block, "a long, b long").distinct()


def near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH
) -> DataFrame:
    """One row for each document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their sets of word shingles have a similarity of 0.8 or more;
    a component is named by its smallest id, which is kept. Null and empty texts have an empty set
    and are linked with nothing. Ids are taken to be unique: rows that repeat an id and its text get
    the same result each. Rows without an id are linked with nothing, get a null component and are
    kept. Other columns play no part, an empty table gives no rows.
    """
    rows = texts(docs, key, text)
    sketch = stored(sketches(rows, width), "near-sketches")
    named = sketch.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        named.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")),
        "near-classes",
    )
    # Different sets of three shingles and fewer cannot be similar enough.
    firsts = named.filter("n > 3").join(
        classes.select("set_key", F.col("first").alias("doc_id")), ["set_key", "doc_id"], "left_semi"
    ).dropDuplicates(["set_key"])
    banded = firsts.select("doc_id", "n", F.posexplode("bands").alias("band", "key"))
    order = F.xxhash64("doc_id", F.col("band") % HEADS)
    heads = banded.groupBy("key").agg(
        F.min_by(F.struct("doc_id", "n"), order).alias("head"), F.count("*").alias("members")
    )
    buckets = stored(heads.filter("members > 1"), "near-heads")
    members = stored(banded.join(buckets.select("key"), "key", "left_semi"), "near-members")
    sets = stored(full_sets(rows, members.select("doc_id").distinct(), width), "near-sets")
    pairs = stored(first_pairs(members, buckets), "near-pairs")
    linked = stored(confirmed(pairs, sets), "near-links")
    labels = components(linked)
    more = stored(remaining_links(members, labels, sets, firsts), "near-more-links")
    above = components(more).select(F.col("node").alias("component"), F.col("component").alias("top"))
    nodes = labels.unionByName(
        more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        .join(labels, "node", "left_anti").withColumn("component", F.col("node"))
    )
    tops = nodes.join(above, "component", "left").select(
        F.col("node").alias("first"), F.coalesce("top", "component").alias("component_id")
    )
    named_class = classes.join(tops, "first", "left").select(
        "set_key", F.coalesce("component_id", "first").alias("component_id")
    )
    out = sketch.join(named_class, "set_key", "left")
    component = F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(
        F.col("component_id")
    )
    return out.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def drop_near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH
) -> DataFrame:
    """The rows, all their columns, of the documents that stay. Rows whose key is surely not among
    those that go are not shuffled. Null keys stay."""
    gone = stored(
        near_copies(docs, key, text, width).filter("NOT kept").select("doc_id"), "near-gone"
    )
    rows = docs.withColumn("__key", F.col(f"`{key}`").cast("long"))
    marked = likely(rows, gone, "__key", "__likely")
    staying = marked.filter("NOT __likely").drop("__likely", "__key")
    checked = marked.filter("__likely").join(
        gone.withColumnRenamed("doc_id", "__key"), "__key", "left_anti"
    )
    return staying.unionByName(checked.drop("__likely", "__key"))


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE len(words) WHEN 0 THEN [] WHEN 1 THEN words
    ELSE [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] END) AS shingle
  FROM w
), n AS (
  SELECT w.doc_id, count(s.shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
  ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 80 * (na.n + nb.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, n.n::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM n JOIN c USING (doc_id)
"""
