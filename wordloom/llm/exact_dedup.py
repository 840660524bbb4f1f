"""Exact copies by two passes over a Bloom filter, with built-in functions only.

Pass one counts filter positions; those hit at least twice become a bitmap table of bounded size,
which is broadcast. Pass two looks every row up: a row with a position hit only once is alone with
its text and passes straight through. Only the others are shuffled, by the digest of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored, texts

# Filter positions for each row, and the bits in one bitmap of Spark's bitmap functions.
BITS_PER_ROW = 16
BITMAP_BITS = 32_768
# The broadcast filter never exceeds this many bitmaps (64 MB). Fuller filters let more rows
# through to the shuffle; results stay the same.
MOST_BITMAPS = 16_384
PROBES = 2
# Ways in which the rows of one group of copies are spread.
SALTS = 16


def normal(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.sha2(normal(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def positions(sha: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(bits)) for i in range(PROBES)]


def repeated_positions(digests: DataFrame) -> tuple[DataFrame, int]:
    """Bitmaps ``(bucket, bitmap)`` of the positions hit at least twice, and the filter's bits."""
    rows = digests.count()
    bits = min(MOST_BITMAPS, -(-max(rows, 1) * BITS_PER_ROW // BITMAP_BITS)) * BITMAP_BITS
    hit = digests.select(F.explode(F.array(*positions(F.col("sha"), bits))).alias("at"))
    twice = hit.groupBy("at").agg(F.count("*").alias("n")).filter("n > 1")
    bitmaps = twice.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")
    )
    return stored(bitmaps, "dedup-filter"), bits


def is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), (bit % 8).cast("int")) == 1


def probed(rows: DataFrame, sha: str, filter_: DataFrame, bits: int, out: str) -> DataFrame:
    """The rows with ``out``: whether all of a row's positions were hit at least twice."""
    found = F.lit(True)
    for i, at in enumerate(positions(F.col(sha), bits)):
        side = filter_.select(
            F.col("bucket").alias(f"{out}_bucket{i}"), F.col("bitmap").alias(f"{out}_bits{i}")
        )
        rows = rows.join(
            F.broadcast(side), F.bitmap_bucket_number(at) == F.col(f"{out}_bucket{i}"), "left"
        )
        hit = is_set(F.col(f"{out}_bits{i}"), F.bitmap_bit_position(at))
        found = found & F.coalesce(hit, F.lit(False))
    extra = [f"{out}_{name}{i}" for name in ("bucket", "bits") for i in range(PROBES)]
    return rows.withColumn(out, found).drop(*extra)


def digests_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = texts(docs, key, text).select("doc_id", digest(F.col("text")).alias("sha"))
    return stored(rows, "dedup-digests")


def groups_of(candidates: DataFrame) -> DataFrame:
    """``sha, keep_id, n`` of the texts that more than one row has."""
    counted = candidates.groupBy("sha").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("n")
    )
    return counted.filter("n > 1")


def decisions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: who stays for it, how many share its text, whether it stays.

    Null texts count as empty. The smallest key of a group stays; null keys come last. Rows that
    repeat key and text get the same decision each (``drop_copies`` keeps one of them). Columns
    other than key and text play no part. An empty table gives no rows.
    """
    digests = digests_of(docs, key, text)
    filter_, bits = repeated_positions(digests)
    rows = probed(digests, "sha", filter_, bits, "again")
    alone = rows.filter("NOT again").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"), "sha"
    )
    candidates = rows.filter("again").select(
        "doc_id", "sha", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")
    )
    salts = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt")
    groups = groups_of(candidates).select("sha", "keep_id", "n", salts)
    grouped = candidates.join(groups, ["sha", "salt"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("n"),
        "sha",
    )
    return alone.unionByName(grouped).select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, all their columns, without those whose text a smaller key has.

    Of rows that repeat key and text one stays. Rows that the filter shows to be alone with their
    text are not shuffled.
    """
    filter_, bits = repeated_positions(digests_of(docs, key, text))
    marked = docs.withColumn("__sha", digest(F.col(f"`{text}`").cast("string")))
    marked = probed(marked, "__sha", filter_, bits, "__again")
    alone = marked.filter("NOT __again").drop("__again", "__sha")
    candidates = marked.filter("__again").drop("__again")
    first = candidates.groupBy("__sha").agg(F.min(f"`{key}`").alias("__keep"))
    first = first.withColumnRenamed("__sha", "__group")
    same = (F.col("__sha") == F.col("__group")) & F.col(f"`{key}`").eqNullSafe(F.col("__keep"))
    staying = candidates.join(first, same, "left_semi").dropDuplicates(["__sha"])
    return alone.unionByName(staying.drop("__sha"))


DECISIONS_SQL = r"""
WITH t AS (
  SELECT doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha
  FROM documents
), g AS (
  SELECT sha, min(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY sha
)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha AS text_sha256
FROM t JOIN g USING (sha)
"""
