"""Compare a Spark result with DuckDB running the oracle SQL on the same
parquet tables: same column names, same row count, same multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    got_names = list(spark_df.columns)
    got = spark_df.collect()
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    result = {
        "rows": (len(got), len(want)),
        "columns_match": sorted(got_names) == sorted(want_names),
        "values_match": False,
    }
    if result["columns_match"]:
        result["values_match"] = _rows(got_names, got) == _rows(want_names, want)
    result["ok"] = (result["columns_match"] and result["values_match"]
                    and len(got) == len(want))
    return result
