"""A bigram language model whose counts live in Elias-Fano tries, one for each shard of contexts.

The corpus is encoded once, in blocks of texts with their own word numbers. Blocks and shards talk
in two exchanges. In the first, a block sends each distinct word with its training count to the
word's shard and gets the word's total back. In the second, it sends each distinct context with
its successors and training counts to the context's shard. The shard builds its trie from what the
training texts sent: sorted contexts, monotone pointers into a level of successors, quantised
probabilities beside them, all in one memory-mapped file. It then looks every pair up, seen in
training or not, and sends the codes back. Blocks sum up their documents' scores.

P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU), P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)). The
trie holds c(v, w) / (c(v) + MU); an unseen pair has the rest alone.
"""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import elias_fano
from wordloom.llm.bpe import portions
from wordloom.llm.common import fold, stored, texts
from wordloom.llm.shingles import mixed, word_hashes
from wordloom.session import shared_folder, shuffle_width

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS = 10
# Weight of the unigram model in a context, as a number of imagined tokens.
MU = 50.0
ADDED = 0.1
# Tokens of a block, and of a shard on average.
BLOCK_TOKENS = 1_200_000
SHARD_TOKENS = 2_000_000
# Codes are 1 + STEPS * -log10(probability), in a byte; 0 is an unseen pair.
STEPS = 32
# Hashes that stand for the end of a text and for the context before its first word.
END, START = 1, 2

BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, "
    "vocabulary binary, sequence binary"
)
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as all their low halves, then all their high halves."""
    halves = numbers.astype("<u4").view("<u2").reshape(-1, 2)
    return halves[:, 0].tobytes() + halves[:, 1].tobytes()


def unplanes(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int32)
    return low | high << 16


def block_row(number: int, docs: list[tuple[int | None, bool, np.ndarray]]) -> pa.RecordBatch:
    """One block; word numbers go by falling frequency, so that most are small."""
    end = np.array([END], np.uint64)
    hashes = np.concatenate([part for _, _, words in docs for part in (words, end)])
    words, numbers, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([[d for d, _, _ in docs]], pa.list_(pa.int64())),
            pa.array([[h for _, h, _ in docs]], pa.list_(pa.bool_())),
            pa.array([[len(w) + 1 for _, _, w in docs]], pa.list_(pa.int32())),
            pa.array([words[order].tobytes()], pa.binary()),
            pa.array([planes(rank[numbers])], pa.binary()),
        ],
        ["block", "doc_ids", "held", "lengths", "vocabulary", "sequence"],
    )


def blocks_of(docs: DataFrame) -> DataFrame:
    """The texts as word numbers, written once; every later step reads them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, tokens = TaskContext.get().partitionId() << 32, [], 0
        for part in portions(batches, "text"):
            for doc_id, text, held in zip(*(c.to_pylist() for c in part.columns), strict=True):
                waiting.append((doc_id, held, word_hashes(text)))
                tokens += len(waiting[-1][2]) + 1
                if tokens >= BLOCK_TOKENS:
                    yield block_row(number, waiting)
                    number, waiting, tokens = number + 1, [], 0
        if waiting:
            yield block_row(number, waiting)

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    blocks = docs.select("doc_id", "text", held.alias("held")).mapInArrow(run, BLOCK_SCHEMA)
    path = shared_folder(docs.sparkSession, "lm-blocks")
    blocks.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(BLOCK_SCHEMA).parquet(path)


class Block:
    """A stored block: words, their numbers token by token, and which tokens train."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.doc_ids, self.held = row["doc_ids"], np.array(row["held"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        self.words = np.frombuffer(row["vocabulary"], np.uint64)
        self.tokens = unplanes(row["sequence"])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.training = np.repeat(~self.held, self.lengths)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.training], minlength=len(self.words))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, successor) word numbers in order, training counts, and the pair of
        every token. The context before a text is the number after the last word."""
        before = np.concatenate([self.tokens[:1], self.tokens[:-1]])
        before[self.starts] = len(self.words)
        keys = before.astype(np.int64) * len(self.words) + self.tokens
        distinct, pair = np.unique(keys, return_inverse=True)
        counts = np.bincount(pair[self.training], minlength=len(distinct))
        return distinct // len(self.words), distinct % len(self.words), counts, pair

    def context_hashes(self) -> np.ndarray:
        return np.append(self.words, np.uint64(START))


def word_shards(words: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(words + np.uint64(3)) % np.uint64(shards)).astype(np.int64)


def successors(words: np.ndarray) -> np.ndarray:
    """What a trie knows a successor by: 32 bits of its hash, within its context."""
    return (mixed(words + np.uint64(5)) >> np.uint64(32)).astype(np.uint32)


def pair_shards(
    contexts: np.ndarray, following: np.ndarray, hot: dict[int, int], ways: dict[int, int], shards: int
) -> np.ndarray:
    """The shard of a context; a hot one is spread by successor over several."""
    salt = np.zeros(len(contexts), np.uint64)
    if hot:
        names = np.array(sorted(hot), np.uint64)
        at = np.minimum(np.searchsorted(names, contexts), len(names) - 1)
        known = names[at] == contexts
        width = np.array([ways[int(h)] for h in names], np.uint64)[at]
        salt[known] = following[known].astype(np.uint64) % width[known] + np.uint64(1)
    return (mixed(contexts + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)


def by_shard(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with the places of its entries, in order."""
    order = np.argsort(shards, kind="stable")
    names, first = np.unique(shards[order], return_index=True)
    for name, places in zip(names.tolist(), np.split(order, first[1:]), strict=True):
        yield name, places


def binary(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds[k]) for k, v in columns.items()], list(columns)
    )


WORD_KINDS = {"shard": pa.int64(), "block": pa.int64(), "words": pa.binary(), "counts": pa.binary()}
PAIR_KINDS = {
    "shard": pa.int64(), "block": pa.int64(), "contexts": pa.binary(), "fan": pa.binary(),
    "following": pa.binary(), "counts": pa.binary(),
}


def sent_words(blocks: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                counts = block.word_counts().astype(np.uint32)
                out: dict[str, list] = {k: [] for k in WORD_KINDS}
                for shard, places in by_shard(word_shards(block.words, shards)):
                    out["shard"].append(shard)
                    out["block"].append(block.number)
                    out["words"].append(block.words[places].tobytes())
                    out["counts"].append(counts[places].tobytes())
                yield binary(out, WORD_KINDS)

    return blocks.mapInArrow(run, "shard long, block long, words binary, counts binary")


def arrays(table: pa.Table, column: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(v, kind) for v in table.column(column).to_pylist()]


def word_totals(sent: DataFrame, hot_from: int) -> DataFrame:
    """``shard, block, data, tokens, words, hot``: training totals in the order that the words
    came, the shard's tokens and known words, and its words with at least ``hot_from`` tokens."""

    def total(table: pa.Table) -> pa.Table:
        words, counts = arrays(table, "words", np.uint64), arrays(table, "counts", np.uint32)
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        sums = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        parts = np.split(sums[place], np.cumsum([len(w) for w in words])[:-1])
        n = table.num_rows
        hot = np.flatnonzero(sums >= hot_from)
        pairs = [
            {"word": int(w), "count": int(c)}
            for w, c in zip(distinct[hot].view(np.int64), sums[hot], strict=True)
        ]
        kind = pa.list_(pa.struct([("word", pa.int64()), ("count", pa.int64())]))
        return pa.table(
            {
                "shard": table.column("shard"),
                "block": table.column("block"),
                "data": pa.array([p.tobytes() for p in parts], pa.binary()),
                "tokens": pa.array([int(sums.sum())] * n, pa.int64()),
                "words": pa.array([int((sums > 0).sum())] * n, pa.int64()),
                "hot": pa.array([pairs] + [[]] * (n - 1), kind),
            }
        )

    return sent.groupBy("shard").applyInArrow(
        total,
        "shard long, block long, data binary, tokens long, words long, "
        "hot array<struct<word: long, count: long>>",
    )


def sent_pairs(blocks: DataFrame, hot: dict[int, int], ways: dict[int, int], shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                before, after, counts, _ = block.pairs()
                contexts, following = block.context_hashes()[before], successors(block.words)[after]
                out: dict[str, list] = {k: [] for k in PAIR_KINDS}
                for shard, places in by_shard(pair_shards(contexts, following, hot, ways, shards)):
                    edge = np.flatnonzero(np.diff(before[places], prepend=-1))
                    out["shard"].append(shard)
                    out["block"].append(block.number)
                    out["contexts"].append(contexts[places][edge].tobytes())
                    out["fan"].append(np.diff(edge, append=len(places)).astype(np.uint32).tobytes())
                    out["following"].append(following[places].tobytes())
                    out["counts"].append(counts[places].astype(np.uint32).tobytes())
                yield binary(out, PAIR_KINDS)

    return blocks.mapInArrow(
        run,
        "shard long, block long, contexts binary, fan binary, following binary, counts binary",
    )


class Trie:
    """Two levels below the root, in one memory-mapped file: contexts, and their successors."""

    def __init__(self, contexts: int, names: int, keys: np.ndarray, probability: np.ndarray):
        """Contexts and successors are numbered in order; ``keys`` are context * names + successor,
        rising, with a probability each."""
        self.names = names
        pointers = np.searchsorted(keys, np.arange(contexts + 1) * names)
        codes = np.clip(np.rint(-np.log10(probability) * STEPS), 0, 254).astype(np.uint8) + 1
        levels = [
            elias_fano.encode(pointers, len(keys) + 1),
            elias_fano.encode(keys, max(1, contexts * names)),
            codes.tobytes(),
        ]
        with tempfile.TemporaryFile() as file:
            for level in levels:
                file.write(level)
            file.flush()
            mapped = np.memmap(file, np.uint8, "r")
        first, second = len(levels[0]), len(levels[0]) + len(levels[1])
        self.pointers = elias_fano.Sequence(mapped[:first])
        self.successors = elias_fano.Sequence(mapped[first:second])
        self.codes = mapped[second:]

    def lookup(self, contexts: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Codes of the pairs, 0 for those that the trie doesn't hold."""
        if not self.successors.n:
            return np.zeros(len(contexts), np.uint8)
        first, last = self.pointers.get(contexts), self.pointers.get(contexts + 1)
        wanted = contexts * self.names + names
        at = self.successors.find(wanted, first.astype(np.int64), last.astype(np.int64))
        return np.where(at >= 0, self.codes[np.maximum(at, 0)], 0).astype(np.uint8)


def pair_codes(sent: DataFrame, hot: dict[int, int], mu: float) -> DataFrame:
    """``shard, block, data``: a code for each pair, in the order that the pairs came."""

    def look_up(table: pa.Table) -> pa.Table:
        contexts, fan = arrays(table, "contexts", np.uint64), arrays(table, "fan", np.uint32)
        following, counts = arrays(table, "following", np.uint32), arrays(table, "counts", np.uint32)
        names, context = np.unique(np.concatenate(contexts), return_inverse=True)
        context = np.repeat(context, np.concatenate(fan))
        after, successor = np.unique(np.concatenate(following), return_inverse=True)
        keys, pair = np.unique(context * len(after) + successor, return_inverse=True)
        together = np.bincount(pair, np.concatenate(counts), len(keys))
        # A context that is spread over shards brings its total; others are here as a whole.
        alone = np.bincount(keys // len(after), together, len(names))
        totals = np.array([hot.get(int(h), c) for h, c in zip(names, alone, strict=True)])
        seen = together > 0
        share = together[seen] / (totals[keys[seen] // len(after)] + mu)
        trie = Trie(len(names), len(after), keys[seen], share)
        codes = trie.lookup(keys // len(after), keys % len(after))[pair]
        parts = np.split(codes, np.cumsum([len(f) for f in following])[:-1])
        return pa.table(
            {
                "shard": table.column("shard"),
                "block": table.column("block"),
                "data": pa.array([p.tobytes() for p in parts], pa.binary()),
            }
        )

    return sent.groupBy("shard").applyInArrow(look_up, "shard long, block long, data binary")


def scored_block(
    block: Block, counts: np.ndarray, codes: np.ndarray, pair: np.ndarray, before: np.ndarray,
    tokens: int, words: int, mu: float,
) -> pa.Table:
    """Scores of a block's documents from its words' totals and its pairs' codes."""
    single = (counts + ADDED) / (tokens + ADDED * (words + 1))
    end = int(np.flatnonzero(block.words == np.uint64(END))[0])
    # As many texts begin as end.
    context_counts = np.append(counts, counts[end])
    share = np.concatenate([[0.0], 10.0 ** (-np.arange(255) / STEPS)])[codes]
    rest = mu / (context_counts[before] + mu)
    chance = share[pair] + rest[pair] * single[block.tokens]
    sums = lambda x: np.add.reduceat(x, block.starts)
    known = (counts > 0).astype(np.int64)[block.tokens]
    return pa.table(
        {
            "doc_id": pa.array(block.doc_ids, pa.int64()),
            "held_out": pa.array(block.held),
            "n_tokens": pa.array(block.lengths),
            "n_known": pa.array(sums(known)),
            "train_tokens": pa.array([tokens] * len(block.lengths), pa.int64()),
            "base_score": pa.array(sums(np.log10(single)[block.tokens])),
            "score": pa.array(sums(np.log10(chance))),
        }
    )


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", mu: float = MU) -> DataFrame:
    """One row for each document: its tokens, its unigram score and the model's, in log10.

    The model learns from documents whose crc32 of the id, written as text, is not divisible by 10;
    rows without an id train as well. Null texts count as empty: one token, the end. Repeated rows
    count and are scored each for itself; other columns play no part; without any training row all
    counts are 0; an empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = blocks_of(texts(docs, key, text))
    total = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    shards = max(shuffle_width(spark), -(-total // SHARD_TOKENS))
    # Fewer words than shards can have this many tokens, so the list of hot ones stays short.
    hot_from = max(1000, -(-total // shards))
    totals = stored(word_totals(sent_words(blocks, shards), hot_from), "lm-words")
    per_shard = totals.groupBy("shard").agg(F.first("tokens").alias("tokens"), F.first("words").alias("words"))
    sums = per_shard.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    tokens, words = sums["tokens"] or 0, sums["words"] or 0
    hot = {
        r["word"] & (1 << 64) - 1: r["count"]
        for r in totals.select(F.explode("hot").alias("hot")).select("hot.*").collect()
    }
    if END in hot:
        hot[START] = hot[END]
    ways = {word: min(shards, 1 + 2 * count // hot_from) for word, count in hot.items()}
    codes = pair_codes(sent_pairs(blocks, hot, ways, shards), hot, mu)
    answers = totals.select("block", "shard", F.lit(0).alias("kind"), "data").unionByName(
        codes.select("block", "shard", F.lit(1).alias("kind"), "data")
    )

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left.to_pylist()[0])
        told = {(r["kind"], r["shard"]): r["data"] for r in right.to_pylist()}
        counts = np.zeros(len(block.words), np.int64)
        for shard, places in by_shard(word_shards(block.words, shards)):
            counts[places] = np.frombuffer(told[0, shard], np.int64)
        before, after, _, pair = block.pairs()
        contexts, following = block.context_hashes()[before], successors(block.words)[after]
        found = np.zeros(len(before), np.uint8)
        for shard, places in by_shard(pair_shards(contexts, following, hot, ways, shards)):
            found[places] = np.frombuffer(told[1, shard], np.uint8)
        return scored_block(block, counts, found, pair, before, tokens, words, mu)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, SCORES)
