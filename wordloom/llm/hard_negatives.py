"""Hard negatives by a vertical scan of quantised vectors (BOND).

Vectors lie in blocks that hold one dimension after another. An anchor reads a block's dimensions
by falling magnitude of its own components and adds them to the partial scores of a bitmap of
candidates. What the dimensions not read yet can still add lies between two sums, from the least
and the largest value of each dimension in the block; candidates whose range leaves the wanted
window, or lies under the best ones already certain, drop out, and the rest get exact scores.

Blocks are sorted by label inside, so the rows of one label are one slice. Every anchor meets every
block twice: for its nearest rows of the same label, and, once these give the windows, for the
nearest rows of other labels within each. Only the anchors travel, once for each block; blocks are
copied only where one would meet more anchors than a task should take.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no
part. Rows are not merged: of repeated rows each counts, also as a positive, negative or anchor;
an anchor's own id is none of its positives. Vectors of different lengths are read as if the
shorter one ended in zeros. Equal scores go by the smaller id. An empty table gives no rows. Scores
are exact; one that doesn't fit a long is an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Components of a block, and of a message of anchors.
BLOCK_VALUES = 1 << 19
MESSAGE_VALUES = 1 << 13
# Messages that one copy of a block meets.
MESSAGES_PER_COPY = 64
# Looks at the bounds, spread evenly over the dimensions.
LOOKS = 8
# Candidates that are few enough to be finished at once.
FEW = 64

# Of an anchor: its positives, and the negatives of each.
POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
# Every such row is an anchor.
ANCHOR_STEP = 50

PACKED = "block int, ids binary, labels binary, dims int, data binary"
MESSAGE = "message long, anchors binary, ids binary, labels binary, dims int, data binary"
NEAR = "message long, anchor long, anchor_id long, score long, vec_id long"
WITHIN = "anchor long, positive_score long, score long, vec_id long"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, vector``: rows that take part, nothing else of the table."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.filter("vec_id IS NOT NULL AND label IS NOT NULL").filter(finite)


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows of equal length."""
    flat, starts = vectors.flatten().to_numpy(), vectors.offsets.to_numpy()
    sizes = np.diff(starts)
    out = np.zeros((len(vectors), dims))
    if len(flat):
        row = np.repeat(np.arange(len(vectors)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(starts[:-1] - starts[0], sizes)] = flat
    return out


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a partition as one block, by label and id, one dimension after another."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks()
    ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
    vectors = table["vector"].combine_chunks()
    vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
    dims = int(np.diff(vectors.offsets.to_numpy()).max())
    order = np.lexsort((ids, labels))
    columns = np.ascontiguousarray(matrix(vectors, dims)[order].T)
    yield pa.RecordBatch.from_pylist(
        [
            {
                "block": table["block"][0].as_py(),
                "ids": ids[order].tobytes(),
                "labels": labels[order].tobytes(),
                "dims": dims,
                "data": columns.tobytes(),
            }
        ],
        schema=pa.schema(
            [("block", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
             ("dims", pa.int32()), ("data", pa.binary())]
        ),
    )


def in_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows in blocks of equal size, stored, and the number of blocks."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).first()
    blocks = max(1, -(-size.n * max(1, size.dims or 0) // BLOCK_VALUES))
    dealt = rows.repartition(blocks).withColumn("block", F.spark_partition_id())
    return stored(dealt.mapInArrow(pack, PACKED), "vector-blocks"), blocks


def messages_of(step: int):
    """Anchors of each block, told apart by block and place, in messages of bounded size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                labels = np.frombuffer(row["labels"], np.int64)
                dims = row["dims"]
                columns = np.frombuffer(row["data"]).reshape(dims, len(ids))
                at = np.flatnonzero(ids % step == 0)
                size = max(1, MESSAGE_VALUES // max(1, dims))
                out = []
                for start in range(0, len(at), size):
                    some = at[start : start + size]
                    first = row["block"] * (1 << 32)
                    out.append(
                        {
                            "message": first + start,
                            "anchors": (first + some).tobytes(),
                            "ids": ids[some].tobytes(),
                            "labels": labels[some].tobytes(),
                            "dims": dims,
                            "data": np.ascontiguousarray(columns[:, some].T).tobytes(),
                        }
                    )
                yield pa.RecordBatch.from_pylist(
                    out,
                    schema=pa.schema(
                        [("message", pa.int64()), ("anchors", pa.binary()), ("ids", pa.binary()),
                         ("labels", pa.binary()), ("dims", pa.int32()), ("data", pa.binary())]
                    ),
                )

    return cut


class Block:
    """One block, with the range of each dimension."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.columns = np.frombuffer(row["data"]).reshape(row["dims"], len(self.ids))
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.largest = np.maximum(np.abs(self.low), np.abs(self.high))

    def slice_of(self, label: int) -> tuple[int, int]:
        first, last = np.searchsorted(self.labels, [label, label + 1])
        return int(first), int(last)


class Scan:
    """The steps of one anchor through the dimensions of one block."""

    def __init__(self, block: Block, anchor: np.ndarray):
        dims = min(len(anchor), len(block.columns))
        order = np.argsort(-np.abs(anchor[:dims]), kind="stable")
        self.order = order[: np.count_nonzero(anchor[:dims])]
        self.block, self.weights = block, anchor[self.order]
        # Whole numbers below 2**53 are exact as doubles; beyond that they are added as such.
        self.exact = float(np.abs(self.weights) @ block.largest[self.order]) < 2.0**53
        ends = self.weights * block.low[self.order], self.weights * block.high[self.order]
        self.least = self.rest(np.minimum(*ends))
        self.most = self.rest(np.maximum(*ends))

    @staticmethod
    def rest(parts: np.ndarray) -> np.ndarray:
        """What the dimensions from each place on can add."""
        return np.concatenate([np.cumsum(parts[::-1])[::-1], [0.0]])

    def run(self, alive: slice | np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of what is left; ``keep`` marks who stays, given partial
        scores and what can still be added at least and at most."""
        places = np.arange(len(self.block.ids))[alive]
        if not self.exact:
            columns = self.block.columns[self.order][:, places]
            whole = [[int(x) for x in c] for c in columns]
            scores = sum(
                (int(w) * np.array(c, object) for w, c in zip(self.weights, whole)),
                np.zeros(len(places), object),
            )
            return places, scores
        scores = np.zeros(len(places))
        step = max(1, -(-len(self.order) // LOOKS))
        done = 0
        while done < len(self.order) and len(places):
            until = len(self.order) if len(places) <= FEW else done + step
            read = self.order[done:until]
            some = self.block.columns[read][:, alive]
            scores = scores + self.weights[done:until] @ some
            done = min(until, len(self.order))
            if done < len(self.order):
                stay = keep(scores, self.least[done], self.most[done])
                if stay is not None and not stay.all():
                    places, scores = places[stay], scores[stay]
                    alive = places
        return places, scores.astype(np.int64)


def first_of(places: np.ndarray, scores: np.ndarray, ids: np.ndarray, n: int) -> list[tuple]:
    """The best n as (score, id), equal scores by id."""
    if len(places) > 4 * n:
        edge = np.partition(scores, len(scores) - n)[len(scores) - n]
        places, scores = places[scores >= edge], scores[scores >= edge]
    found = sorted(zip((-int(s) for s in scores), ids[places].tolist()))[:n]
    return [(-s, i) for s, i in found]


def nearest(block: Block, anchor: np.ndarray, own: int, label: int, n: int) -> list[tuple]:
    """The best n rows of the label, without the anchor's own id."""
    first, last = block.slice_of(label)
    if first == last:
        return []
    alive: slice | np.ndarray = slice(first, last)
    others = block.ids[alive] != own
    if not others.all():
        alive = first + np.flatnonzero(others)

    def keep(scores, least, most):
        if len(scores) <= n:
            return None
        sure = np.partition(scores, len(scores) - n)[len(scores) - n] + least
        return scores + most >= sure

    return first_of(*Scan(block, anchor).run(alive, keep), block.ids, n)


def within(
    block: Block, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], n: int
) -> list[list[tuple]]:
    """The best n rows of other labels within each window of scores."""
    first, last = block.slice_of(label)
    alive = np.concatenate([np.arange(first), np.arange(last, len(block.ids))])
    floors = np.array([w[0] for w in windows], float)
    tops = np.array([w[1] for w in windows], float)
    scan = Scan(block, anchor)
    if scan.exact and (scan.most[0] < floors.min() or scan.least[0] > tops.max()):
        return [[] for _ in windows]

    def keep(scores, least, most):
        for i in range(len(floors)):
            # Rows that lie inside the window whatever follows: under the n-th of them none counts.
            if most - least <= tops[i] - floors[i]:
                sure = scores[(scores + least >= floors[i]) & (scores + most <= tops[i])]
                if len(sure) >= n:
                    edge = np.partition(sure, len(sure) - n)[len(sure) - n] + least
                    floors[i] = max(floors[i], edge)
        stay = np.zeros(len(scores), bool)
        for low, high in {*zip(floors.tolist(), tops.tolist())}:
            stay |= (scores + most >= low) & (scores + least <= high)
        return stay

    places, scores = scan.run(alive, keep)
    out = []
    for low, high in windows:
        inside = np.flatnonzero(np.array((scores >= low) & (scores <= high), bool))
        out.append(first_of(places[inside], scores[inside], block.ids, n))
    return out


def message_rows(row: dict) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """The anchors of a message: number, id, label, vector."""
    anchors, ids, labels = (np.frombuffer(row[k], np.int64) for k in ("anchors", "ids", "labels"))
    vectors = np.frombuffer(row["data"]).reshape(len(ids), row["dims"])
    yield from zip(anchors.tolist(), ids.tolist(), labels.tolist(), vectors)


def batch_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def met(batches: Iterator[pa.RecordBatch], answer, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Each message answered by the block that stands before it."""
    block = None
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["message"] is None:
                block = Block(row)
            else:
                out.extend(answer(block, row))
        if out:
            yield batch_of(out, names)


def find_positives(n: int):
    def answer(block: Block, row: dict) -> Iterator[tuple]:
        for anchor, own, label, vector in message_rows(row):
            for score, other in nearest(block, vector, own, label, n):
                yield row["message"], anchor, own, score, other

    names = ["message", "anchor", "anchor_id", "score", "vec_id"]
    return lambda batches: met(batches, answer, names)


def find_negatives(n: int, low: int, high: int):
    def answer(block: Block, row: dict) -> Iterator[tuple]:
        wanted: dict[int, set[int]] = {}
        for w in row["wanted"]:
            wanted.setdefault(w["anchor"], set()).add(w["positive_score"])
        for anchor, _, label, vector in message_rows(row):
            windows = {s: (-(-low * s // 100), high * s // 100) for s in wanted.get(anchor, ())}
            windows = {s: w for s, w in windows.items() if w[0] <= w[1]}
            if windows:
                found = within(block, vector, label, list(windows.values()), n)
                for positive, best in zip(windows, found):
                    for score, other in best:
                        yield anchor, positive, score, other

    names = ["anchor", "positive_score", "score", "vec_id"]
    return lambda batches: met(batches, answer, names)


def meetings(blocks: DataFrame, count: int, messages: DataFrame, copies: int) -> DataFrame:
    """Each copy of a block, followed by the messages that it answers."""
    copy = F.pmod(F.xxhash64("message"), F.lit(copies)).cast("int")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("block")
    every_copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    asked = messages.select(every_block, copy.alias("copy"), *messages.columns)
    rows = blocks.select("*", every_copy).unionByName(asked, allowMissingColumns=True)
    return rows.repartition("block", "copy").sortWithinPartitions("block", "copy", "message")


def hard_negatives(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    step: int = ANCHOR_STEP,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, label, vector`` with whole numbers as components.
    """
    blocks, count = in_blocks(usable(vectors))
    messages = stored(blocks.mapInArrow(messages_of(step), MESSAGE), "anchors")
    copies = max(1, -(-messages.count() // MESSAGES_PER_COPY))

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    near = meetings(blocks, count, messages, copies).mapInArrow(find_positives(positives), NEAR)
    near = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= positives)
    chosen = stored(
        near.select(
            "message",
            "anchor",
            "anchor_id",
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # A message holds few anchors, and each has few positives.
    wanted = chosen.groupBy("message").agg(
        F.collect_set(F.struct("anchor", "positive_score")).alias("wanted")
    )
    asked = messages.join(wanted, "message")
    found = meetings(blocks, count, asked, copies).mapInArrow(
        find_negatives(negatives, low, high), WITHIN
    )
    best = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best))
    found = found.filter(F.col("rank") <= negatives)
    return found.join(chosen, ["anchor", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def quantised(embedding: Column, scale: int) -> Column:
    """Each component as a whole number of steps, as doubles."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_inner_product(a.vector, o.vector)::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
