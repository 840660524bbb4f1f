"""What the operators share: reading tables, whole texts, and caches of a worker process."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["fold", "read", "stored", "texts", "worker_cache"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Rows that Spark hands to a worker at once, where the session doesn't say: texts can be long.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 1000


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the whole text, null as empty; all other columns are left behind."""
    if docs.sparkSession.conf.get(BATCH_ROWS, None) is None:
        docs.sparkSession.conf.set(BATCH_ROWS, str(TEXTS_PER_BATCH))
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )


def fold(doc_id: Column, parts: int) -> Column:
    """The part a document falls in: crc32 of its id, written as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def worker_cache(name: str) -> dict:
    """A dictionary that outlives a task of this worker process, until another name is asked for.

    One operator's memory at a time, since stages of different ones share their workers.
    """
    module = sys.modules.setdefault("_wordloom_worker", types.ModuleType("_wordloom_worker"))
    if getattr(module, "name", None) != name:
        module.name, module.cache = name, {}
    return module.cache
