"""Session settings the jobs are written for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# How many partitions the caller wants small text tables spread over; unset, they are left as
# they are read.
TEXT_PARTITIONS = "spark.wordloom.textPartitions"

# AQE turns measured-small join sides into broadcasts, splits skewed join partitions and
# merges small ones; runtime filters trim the big side of shuffled joins.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "8", partitions: int = 8, **extra) -> SparkSession:
    """A session for tests and single-machine runs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("wordloom")
    settings = {
        **RECOMMENDED,
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.sql.shuffle.partitions": str(partitions),
        TEXT_PARTITIONS: str(partitions),
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's stored tables, below ``spark.checkpoint.dir``.

    All executors must reach it. Where the setting is absent, a local master gets a temporary
    folder; on a cluster that would be a different disk for every executor, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wordloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/wordloom-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the run's folder."""
    return f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def clear_run(spark: SparkSession) -> None:
    """Remove everything that this run has stored; results not yet written read from there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    """How many ways a hot group is spread: the cluster's own shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table; its size is known to the planner, so joins to it broadcast it."""
    struct = T.StructType.fromDDL(schema)
    records = [dict(zip(struct.names, row)) for row in rows]
    return spark.createDataFrame(
        pa.Table.from_pylist(records, schema=to_arrow_schema(struct)), schema=struct
    )


# Rows that a broadcast table may have.
BROADCAST_ROWS = 100_000


def joinable(table: DataFrame, join: str = "merge") -> DataFrame:
    """A stored table as the side of a join: never broadcast if it has many rows.

    ``join`` is the hint it gets instead; ``shuffle_hash`` spares a much larger other side the sort.

    Parquet packs repeated values, so the size of its files, which Spark's threshold goes by, says
    little of the memory that the rows take in a driver.
    """
    return table if table.count() <= BROADCAST_ROWS else table.hint(join)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Computed once however often they are used, safe against lost executors, and of a size
    the planner knows: joins broadcast them only below Spark's own threshold.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
