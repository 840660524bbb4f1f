"""Harmonic packing of token sequences.

A piece of length r belongs to the class k with capacity/(k+1) < r <= capacity/k, and a bin of that
class takes exactly k pieces, so that bins are filled one after another without looking at what
else is there, by each worker for itself. Lengths that would leave too much of a bin unused are cut
at the next class's bound first. A worker's last open bins are joined, cut to the capacity, and the
rest to powers of two, which need no padding.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

from wordloom.llm.bpe import encoder, portions, write_model
from wordloom.llm.common import texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A length is cut when a bin of its class would leave more than this share unused.
WASTE = 1 / 64
# Lengths below this are never cut: their bins lose less than one such length.
SHORT = 32
# Pieces handed back to Spark at a time.
PIECES_PER_BATCH = 20_000

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)


def cuts(length: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if rest < SHORT or capacity - k * rest <= WASTE * capacity:
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def powers(length: int) -> list[int]:
    """Falling powers of two that sum to the length."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


class Worker:
    """Open bins of one worker: at most one for each class, each under the capacity."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[tuple]] = {}

    def close(self, pieces: list[tuple]) -> list[tuple]:
        """Rows of a finished sequence; a piece is (doc_id, start, ids, doc_tokens)."""
        rows, offset, sequence = [], 0, self.next
        self.next += 1
        for doc_id, start, ids, tokens in pieces:
            rows.append((doc_id, start, len(ids) // 4, ids, tokens, sequence, offset))
            offset += len(ids) // 4
        return rows

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        rows, start, tokens = [], 0, len(ids) // 4
        for length in cuts(tokens, self.capacity):
            k = self.capacity // length
            pieces = self.open.setdefault(k, [])
            pieces.append((doc_id, start, ids[4 * start : 4 * (start + length)], tokens))
            start += length
            if len(pieces) == k:
                rows += self.close(self.open.pop(k))
        return rows

    def finish(self) -> list[tuple]:
        rest = [piece for k in sorted(self.open) for piece in self.open[k]]
        total = sum(len(piece[2]) for piece in rest) // 4
        rows, queue = [], iter(rest)
        piece = next(queue, None)
        for size in [self.capacity] * (total // self.capacity) + powers(total % self.capacity):
            room, taken = size, []
            while room:
                doc_id, start, ids, tokens = piece
                taken.append((doc_id, start, ids[: 4 * room], tokens))
                used = min(room, len(ids) // 4)
                room -= used
                piece = (doc_id, start + used, ids[4 * used :], tokens)
                if not piece[2]:
                    piece = next(queue, None)
            rows += self.close(taken)
        self.open = {}
        return rows


def pack(
    docs: DataFrame, vocabulary: list[bytes], pattern: str, capacity: int = 1024, end: int = 0
) -> DataFrame:
    """One row for each piece: its ids, and its place in a sequence of at most ``capacity``.

    Each document's ids are followed by the id ``end``; null texts count as empty, so such
    documents consist of ``end`` alone. Repeated rows are packed each for itself, null keys stay
    null, other columns are ignored, an empty table gives no rows. One map, no shuffle: a lost
    task is run again over the same rows and gives the same sequences.
    """
    model = docs.sparkSession.sparkContext.broadcast(write_model(vocabulary))
    last = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of: Callable[[str], bytes] = encoder(model.value, pattern)
        worker = Worker(capacity, TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []
        for part in portions(batches, "text"):
            doc_ids, values = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            for doc_id, text in zip(doc_ids, values, strict=True):
                rows += worker.add(doc_id, ids_of(text) + last)
                while len(rows) >= PIECES_PER_BATCH:
                    yield table(rows[:PIECES_PER_BATCH])
                    rows = rows[PIECES_PER_BATCH:]
        rows += worker.finish()
        for first in range(0, len(rows), PIECES_PER_BATCH):
            yield table(rows[first : first + PIECES_PER_BATCH])

    return texts(docs).mapInArrow(run, SCHEMA)


def table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )
