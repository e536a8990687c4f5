"""Order-insensitive comparison of a Spark result with an oracle SQL result.

Used by the tests: row count, column names and a multiset of normalised
row tuples (decimals, dates, timestamps and floats rendered canonically).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_conn(root: str):
    import duckdb  # noqa: PLC0415
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(root, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}"
    if isinstance(v, int):
        return int(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str) -> dict:
    s_cols = [c for c in spark_df.columns]
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": sorted(s_cols) == sorted(o_cols)}
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(o_cols))
        out["oracle_only"] = sorted(set(o_cols) - set(s_cols))
        out["match"] = False
        return out
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["spark_not_oracle"] = sorted(sa - sb, key=str)[:3]
        out["oracle_not_spark"] = sorted(sb - sa, key=str)[:3]
        out["sorted_columns"] = sorted(s_cols)
    return out
