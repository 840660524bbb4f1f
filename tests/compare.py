"""Order-insensitive comparison of a Spark result with the SQL oracle's."""

from __future__ import annotations

import collections
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def row_counts(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql):
    """``(message or None, rows)``."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    types = dict(zip(names, [str(d[1]) for d in relation.description]))
    want = row_counts(names, relation.fetchall())
    got_rows = spark_df.collect()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}", len(got_rows)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, kind in spark_df.dtypes:
        if kinds.get(kind, kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}", len(got_rows)
    got = row_counts(spark_df.columns, got_rows)
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(extra.values())} extra, {sum(missing.values())} missing of {sum(want.values())}; "
            f"extra {list(extra)[:2]} missing {list(missing)[:2]}"
        ), len(got_rows)
    return None, len(got_rows)
