"""Byte-level BPE by a sentencepiece model that is written out from a rank file.

Every byte becomes one printable character; a vocabulary entry becomes the piece spelt with these
characters, scored by its negative rank, so that the best-scored merge is the lowest-ranked one.
Text is cut into pre-tokens first and each is encoded alone. Decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bounds of memory: remembered pre-tokens of a worker, and texts that make up one output batch.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 64
TEXT_PER_BATCH = 1 << 20

# Texts of these characters only are cut by the plain pattern, to the same pieces.
PLAIN = r"[\t\n\r -~À-ÖØ-öø-ÿ]*"
PLAIN_PIECES = (
    r" ?[a-zA-ZÀ-ÖØ-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+"
    r"| ?[^\sa-zA-Z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+"
)
# The pre-token pattern that the plain one stands for; another pattern is used as it is.
GENERAL_PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Numbers of the sentencepiece model format: field numbers, piece types, the BPE model type.
NORMAL, UNKNOWN, BPE_MODEL = 1, 2, 2


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary in rank order."""
    with open(path, "rb") as file:
        entries = [line.split() for line in file if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in entries)
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in ranked]


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it is printable, else from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _integer(field: int, n: int) -> bytes:
    return _number(field << 3) + _number(n)


def _block(field: int, data: bytes) -> bytes:
    return _number(field << 3 | 2) + _number(len(data)) + data


def _piece(text: str, score: float, kind: int) -> bytes:
    number = _number(2 << 3 | 5) + struct.pack("<f", score)
    return _block(1, _block(1, text.encode()) + number + _integer(3, kind))


def write_model(vocabulary: list[bytes]) -> bytes:
    """A sentencepiece BPE model: ids are ranks, identity normalisation, no added spaces."""
    letters = byte_characters()
    pieces = [
        _piece("".join(letters[b] for b in token), -float(rank), NORMAL)
        for rank, token in enumerate(vocabulary)
    ]
    unknown = _piece("<unk>", 0.0, UNKNOWN)
    trainer = _integer(3, BPE_MODEL) + _integer(40, len(vocabulary))
    normalizer = _block(1, b"identity") + _integer(3, 0) + _integer(4, 0) + _integer(5, 0)
    return b"".join([*pieces, unknown, _block(2, trainer), _block(3, normalizer)])


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into pre-tokens, as the given pattern does."""
    import regex

    general = regex.compile(pattern).findall
    if pattern != GENERAL_PIECES:
        return general
    plain, pieces = re.compile(PLAIN).fullmatch, re.compile(PLAIN_PIECES).findall
    return lambda text: pieces(text) if plain(text) else general(text)


class Pieces(dict):
    """Pre-token -> ids as little-endian uint32 bytes; encodes and remembers what it lacks."""

    def __init__(self, model: bytes):
        import sentencepiece

        super().__init__()
        self.encode = sentencepiece.SentencePieceProcessor(model_proto=model).encode
        self.letters = dict(enumerate(byte_characters()))

    def __missing__(self, piece: str) -> bytes:
        spelt = piece.encode().decode("latin-1").translate(self.letters)
        ids = self.encode(spelt)
        data = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = data
        return data


def encoder(model: bytes, pattern: str) -> Callable[[str], bytes]:
    """Text -> ids as little-endian uint32 bytes, with the memory of this worker process."""
    cache = worker_cache("bpe")
    if cache.get("model") != (model, pattern):
        cache["pieces"] = Pieces(model)
        cache["model"] = (model, pattern)
    pieces, split = cache["pieces"], splitter(pattern)
    return lambda text: b"".join(map(pieces.__getitem__, split(text)))


def id_lists(data: list[bytes]) -> pa.Array:
    """Lists of ids without a Python object for each id."""
    offsets = np.fromiter(accumulate((len(d) // 4 for d in data), initial=0), np.int32)
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(data), np.int32))


def portions(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``TEXT_PER_BATCH`` bytes, so outputs stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, TEXT_PER_BATCH * batch.num_rows // max(1, batch.column(column).nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def encode(docs: DataFrame, vocabulary: list[bytes], pattern: str) -> DataFrame:
    """``doc_id, ids array<int>``: the ids of every whole text.

    One map over the rows, nothing shuffled. Null texts count as empty and give no ids; rows that
    repeat are encoded each for itself; null keys stay null; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(write_model(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(model.value, pattern)
        for part in portions(batches, "text"):
            ids = id_lists([ids_of(t) for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, ids, decoded binary``: the bytes that the ids stand for.

    Null ids give empty bytes; an id outside the vocabulary is an error.
    """
    table = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = table.value.__getitem__
        for part in portions(batches, "ids"):
            lists = part.column("ids")
            decoded = [b"".join(map(bytes_of, x or ())) for x in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), lists, pa.array(decoded, pa.binary())],
                ["doc_id", "ids", "decoded"],
            )

    return encoded.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Number and SHA-256 of the ids, written in decimal, and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
