"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive comparison of values with
columns sorted by name.  Used by the tests and during development."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

from candlewick.sources.tables import TEST_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in row)


def compare(spark_df, con, sql: str, max_show: int = 5) -> dict:
    cols = sorted(spark_df.columns)
    s_rows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()]
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_idx = [o_cols.index(c) for c in cols if c in o_cols]
    res = {"spark_rows": len(s_rows), "columns_match": sorted(o_cols) == cols}
    o_all = rel.fetchall()
    res["oracle_rows"] = len(o_all)
    if not res["columns_match"]:
        res["spark_cols"] = cols
        res["oracle_cols"] = sorted(o_cols)
        res["match"] = False
        return res
    o_rows = [tuple(_norm(r[i]) for i in o_idx) for r in o_all]
    s_sorted = sorted(s_rows, key=_key)
    o_sorted = sorted(o_rows, key=_key)
    res["match"] = s_sorted == o_sorted
    if not res["match"]:
        s_set, o_set = {}, {}
        for r in s_sorted:
            s_set[r] = s_set.get(r, 0) + 1
        for r in o_sorted:
            o_set[r] = o_set.get(r, 0) + 1
        only_s = [r for r in s_set if s_set[r] != o_set.get(r, 0)][:max_show]
        only_o = [r for r in o_set if o_set[r] != s_set.get(r, 0)][:max_show]
        res["columns"] = cols
        res["only_spark"] = only_s
        res["only_oracle"] = only_o
    return res
