"""Resharding by minimum-cost flow: new capacities with the fewest bytes moved.

Documents lie in old shards, each cut into a fixed number of blocks by the magnitude of the size,
large documents first, and a hash of the id. Sums for each block, a table of bounded size, go to
the driver, which solves the flow between the shards that have too much and those that have too
little, and gives every block its targets. A shard keeps its first blocks, so that cuts fall among
smaller documents. At the two ends of a transfer a block is cut between documents. Rows are then
numbered within their new shards, and the documents of blocks that lose rows are written anew, a
bundle of blocks for the same shard by each task, so that a shard gets few files; the files of all
other blocks stay.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import stored
from wordloom.session import local_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 16
# Magnitudes of sizes, from 2**23 bytes and more to 1, and blocks of one magnitude in a shard.
MAGNITUDES = 24
BLOCKS = 64
# Bytes of documents that a task writes anew, unless a single block has more.
BUNDLE_BYTES = 16 << 20


def capacities(total: int, shards: int, shares: Sequence[int] | None = None) -> list[int]:
    """The bytes in proportion to the shares, equal ones unless given; the first shards take what
    doesn't divide."""
    shares = [1] * shards if shares is None else list(shares)
    if len(shares) != shards or min(shares) < 0 or not sum(shares):
        raise ValueError(f"{shards} shards need as many shares, none below 0 and not all 0")
    out = [total * share // sum(shares) for share in shares]
    rest = total - sum(out)
    for i, share in enumerate(shares):
        if share and rest:
            out[i], rest = out[i] + 1, rest - 1
    return out


def cheapest_flow(
    supply: list[int], demand: list[int], cost: list[list[int]]
) -> dict[tuple[int, int], int]:
    """Least-cost amounts from i to j that use up the supply and meet the demand.

    Successive cheapest paths through the residual network of the two sides, found by relaxing
    edges. The sums of both sides must be equal.
    """
    left, right = [i for i, s in enumerate(supply) if s], [j for j, d in enumerate(demand) if d]
    have, want = dict(enumerate(supply)), dict(enumerate(demand))
    flow: dict[tuple[int, int], int] = defaultdict(int)
    while any(have[i] for i in left):
        price = {("from", i): 0 for i in left if have[i]}
        before: dict = {}
        changed = True
        while changed:
            changed = False
            for i in left:
                for j in right:
                    a, b = ("from", i), ("to", j)
                    if a in price and price[a] + cost[i][j] < price.get(b, float("inf")):
                        price[b], before[b], changed = price[a] + cost[i][j], a, True
                    if flow[i, j] and b in price and price[b] - cost[i][j] < price.get(a, float("inf")):
                        price[a], before[a], changed = price[b] - cost[i][j], b, True
        end = min((("to", j) for j in right if want[j]), key=lambda node: price[node])
        path = [end]
        while path[-1] in before:
            path.append(before[path[-1]])
        path.reverse()
        steps = list(zip(path, path[1:]))
        amount = min(have[path[0][1]], want[end[1]])
        for a, b in steps:
            if a[0] == "to":
                amount = min(amount, flow[b[1], a[1]])
        for a, b in steps:
            if a[0] == "from":
                flow[a[1], b[1]] += amount
            else:
                flow[b[1], a[1]] -= amount
        have[path[0][1]] -= amount
        want[end[1]] -= amount
    return {pair: amount for pair, amount in flow.items() if amount}


def transfers(
    sizes: list[int], targets: list[int], cost: list[list[int]] | None = None
) -> dict[tuple[int, int], int]:
    """Bytes to move from shard i to shard j. A byte costs the same between any two shards unless
    ``cost`` says otherwise; a byte that stays costs nothing, so only a surplus moves."""
    n = len(sizes)
    supply = [max(0, s - t) for s, t in zip(sizes, targets, strict=True)]
    demand = [max(0, t - s) for s, t in zip(sizes, targets, strict=True)]
    return cheapest_flow(supply, demand, cost or [[int(i != j) for j in range(n)] for i in range(n)])


def targets_of_blocks(
    blocks: list[tuple[int, int, int]], targets: list[int], cost: list[list[int]] | None = None
) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """``(old, block, [(from byte of the block, shard), ...])`` for each ``(old, block, bytes)``.

    A shard keeps its first bytes; what follows goes out in one stretch for each transfer. Old
    shards beyond the targets are emptied.
    """
    if min((old for old, _, _ in blocks), default=0) < 0:
        raise ValueError("old shards are numbered from 0")
    width = max([len(targets), *(old + 1 for old, _, _ in blocks)])
    targets = [*targets, *[0] * (width - len(targets))]
    sizes = [0] * width
    for old, _, size in blocks:
        sizes[old] += size
    moves = transfers(sizes, targets, cost)
    stretches = {}
    for i, size in enumerate(sizes):
        at = min(size, targets[i])
        stretches[i] = [(0, i)] if at else []
        for j in range(len(targets)):
            if amount := moves.get((i, j), 0):
                stretches[i].append((at, j))
                at += amount
    out, begin = [], dict.fromkeys(range(len(targets)), 0)
    for old, block, size in sorted(blocks):
        first, last = begin[old], begin[old] + size
        begin[old] = last
        here = [(max(0, at - first), shard) for at, shard in stretches[old] if at < last]
        while len(here) > 1 and here[1][0] == 0:
            here.pop(0)
        out.append((old, block, here))
    return out


def bundles(
    blocks: list[tuple[int, int, int]],
    plan: list[tuple[int, int, list[tuple[int, int]]]],
    most: int = BUNDLE_BYTES,
) -> dict[tuple[int, int], int]:
    """The bundle, numbered from 0, of each ``(old, block)`` that may lose rows.

    The blocks of a bundle go to the same shard, a cut one by its last rows, and have at most
    ``most`` bytes together, unless it is one block.
    """
    sizes = {(old, block): size for old, block, size in blocks}
    bound = sorted(
        (here[-1][1], old, block) for old, block, here in plan if any(shard != old for _, shard in here)
    )
    out, at, filled, before = {}, -1, 0, None
    for shard, old, block in bound:
        size = sizes[old, block]
        if shard != before or filled + size > most:
            at, filled, before = at + 1, 0, shard
        out[old, block], filled = at, filled + size
    return out


def measured(docs: DataFrame, old: Column, blocks: int, key: str, text: str, *carried: Column) -> DataFrame:
    """``doc_id, size, text_crc32, old_shard, block`` of every document, and what is carried."""
    data = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.coalesce(old.cast("int"), F.lit(0)).alias("old_shard"),
        *carried,
    )
    magnitude = F.greatest(F.lit(0), MAGNITUDES - 1 - F.floor(F.log2("size")))
    way = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(blocks))
    return rows.withColumn("block", (magnitude * blocks + way).cast("int"))


def positioned(rows: DataFrame, plan: DataFrame, *dealt: str) -> DataFrame:
    """The rows with their number in the old block, ``place``, and their new ``shard``.

    Rows that tie are the same in id, size and checksum, so that every run over the same rows
    places as many of them alike. ``dealt`` names columns, equal within a block, by which the rows
    have been dealt out before.
    """
    inside = Window.partitionBy(*dealt, "old_shard", "block").orderBy("doc_id", "text_crc32", "size")
    begins = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumns(
        {"begin": F.coalesce(begins, F.lit(0)), "place": F.row_number().over(inside)}
    ).join(F.broadcast(plan), ["old_shard", "block"])
    # A document goes where its middle byte lies.
    reached = F.filter("stretches", lambda s: s["from"] * 2 <= F.col("begin") * 2 + F.col("size"))
    shard = F.element_at(reached, -1)["shard"]
    return placed.withColumn("shard", shard).drop("begin", "stretches")


def placement(
    docs: DataFrame,
    old: Column,
    shards: int,
    blocks: int,
    key: str,
    text: str,
    shares: Sequence[int] | None,
    most: int = BUNDLE_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """The positioned rows, without texts; the plan of blocks; the first slot of every piece; the
    bundles of blocks that may lose rows, and their number."""
    rows = stored(measured(docs, old, blocks, key, text), "shard-sizes")
    sums = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("size")).collect()
    sized = [(r["old_shard"], r["block"], r["size"]) for r in sums]
    total = sum(size for _, _, size in sized)
    targets = targets_of_blocks(sized, capacities(total, shards, shares))
    plan = local_table(
        docs.sparkSession,
        [(o, b, [{"from": at, "shard": shard} for at, shard in here]) for o, b, here in targets],
        "old_shard int, block int, stretches array<struct<`from`: long, shard: int>>",
    )
    bundled = bundles(sized, targets, most)
    bundle = local_table(
        docs.sparkSession,
        [(o, b, number) for (o, b), number in bundled.items()],
        "old_shard int, block int, bundle int",
    )
    placed = stored(positioned(rows, plan), "shard-places")
    pieces = placed.groupBy("shard", "old_shard", "block").agg(
        F.count("*").alias("n"), F.min("place").alias("lowest")
    )
    earlier = Window.partitionBy("shard").orderBy("old_shard", "block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    first = pieces.select("shard", "old_shard", "block", (before - F.col("lowest")).alias("first"))
    return placed, plan, stored(first, "shard-pieces"), bundle, len(set(bundled.values()))


def slotted(placed: DataFrame, first: DataFrame, *columns: str) -> DataFrame:
    """The columns, and the ``slot`` within the new shard."""
    joined = placed.join(F.broadcast(first), ["shard", "old_shard", "block"])
    return joined.select(*columns, (F.col("first") + F.col("place")).alias("slot"))


PLACE = ("doc_id", "size", "text_crc32", "old_shard", "block", "shard")


def reshard(
    docs: DataFrame,
    old: Column,
    shards: int = SHARDS,
    blocks: int = BLOCKS,
    key: str = "doc_id",
    text: str = "text",
    shares: Sequence[int] | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, old_shard, block, shard, slot`` of every document.

    ``old`` gives the shard a document lies in now, of any number from 0. New shards hold bytes in
    proportion to ``shares``, equal ones unless given, but for half a document at each cut. Slots
    run from 0 in each shard, by old shard, block and id. The size is the text's UTF-8 bytes plus
    1; null texts count as empty. Rows that repeat get a slot each; null ids come first in their
    block; other columns play no part; an empty table gives no rows.
    """
    placed, _, first, _, _ = placement(docs, old, shards, blocks, key, text, shares)
    return slotted(placed, first, *PLACE)


def reshard_and_rewrite(
    docs: DataFrame,
    old: Column,
    folder: str,
    shards: int = SHARDS,
    blocks: int = BLOCKS,
    key: str = "doc_id",
    text: str = "text",
    shares: Sequence[int] | None = None,
    most: int = BUNDLE_BYTES,
) -> DataFrame:
    """What ``reshard`` gives, with the documents of the blocks that lose rows written anew.

    Their rows go to ``folder/shard=N`` as ``document`` (all columns), ``old_shard``, ``block``,
    ``slot``; their sizes and checksums in the result are those of the written texts. A document
    takes its columns along to its place, so that null and repeated ids are written once a row.
    Blocks that lose nothing are neither moved nor written. A task writes a bundle of blocks for one
    shard, ``most`` bytes unless a block has more: one file, and another for each cut in it.
    """
    placed, plan, first, bundle, number = placement(docs, old, shards, blocks, key, text, shares, most)
    losing = first.filter("shard <> old_shard").select("old_shard", "block").distinct()
    bundle = bundle.join(F.broadcast(losing), ["old_shard", "block"], "left_semi")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document")
    moving = measured(docs, old, blocks, key, text, whole)
    moving = moving.join(F.broadcast(bundle), ["old_shard", "block"])
    moving = moving.repartitionById(max(1, number), "bundle")
    moving = positioned(moving, plan, "bundle")
    written = slotted(moving, first, "document", "old_shard", "block", "shard")
    written.write.partitionBy("shard").parquet(folder)
    found = docs.sparkSession.read.schema(written.schema).parquet(folder)
    data = F.coalesce(F.col("document")[text].cast("string"), F.lit("")).cast("binary")
    rewritten = found.select(
        F.col("document")[key].alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        *PLACE[3:],
        "slot",
    )
    stay = placed.join(F.broadcast(losing), ["old_shard", "block"], "left_anti")
    return slotted(stay, first, *PLACE).unionByName(rewritten)


def rewrite_affected(
    docs: DataFrame, placed: DataFrame, folder: str, key: str = "doc_id", text: str = "text"
) -> None:
    """Writes anew, under ``folder/shard=N``, the documents of the blocks that lose rows.

    For places that were computed before. Files of all other blocks stay as they are. Rows of the
    same id, size and checksum take the places of such rows in turn, one each.
    """
    moved = placed.filter("shard <> old_shard").select("old_shard", "block").distinct()
    same = Window.partitionBy("doc_id", "size", "text_crc32")
    places = placed.withColumn("turn", F.row_number().over(same.orderBy("shard", "slot")))
    places = places.join(F.broadcast(moved), ["old_shard", "block"]).select(
        "doc_id", "size", "text_crc32", "turn", "shard", "slot"
    )
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document")
    rows = measured(docs, F.lit(0), 1, key, text, whole)
    rows = rows.withColumn("turn", F.row_number().over(same.orderBy(F.lit(0))))
    equal = [rows[name].eqNullSafe(places[name]) for name in ("doc_id", "size", "text_crc32", "turn")]
    rows = rows.join(places, equal).select("document.*", "shard", "slot")
    rows.repartition("shard", F.pmod(F.col("slot"), F.lit(16))).write.partitionBy("shard").parquet(folder)
