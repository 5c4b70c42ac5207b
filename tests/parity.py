"""Run a Spark query and its checking SQL on the same tables and compare the results."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("float", value)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    return value if value is None or isinstance(value, str) else str(value)


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> dict:
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    sql_cols = [d[0] for d in cur.description]
    sql_rows = cur.fetchall()
    left, right = _multiset(df.columns, spark_rows), _multiset(sql_cols, sql_rows)
    return {
        "columns": sorted(df.columns) == sorted(sql_cols),
        "rows": (len(spark_rows), len(sql_rows)),
        "only_spark": list((left - right).elements())[:3],
        "only_sql": list((right - left).elements())[:3],
        "differ": sum((left - right).values()) + sum((right - left).values()),
    }
