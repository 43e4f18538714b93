"""Run catalogue queries in Spark and their SQL in DuckDB, and compare.

Usable from pytest and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
Results are compared as multisets of rows with columns sorted by name;
floats must agree exactly ("exact") or to 1e-9 relative ("close").
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, close: bool):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}") if close else v
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, close) for x in v)
    return v


_DUCK_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
               "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
               "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def spark_type_as_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper()
    return _DUCK_NAMES.get(t, t.upper())


def _rows(cols, rows, close):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], close) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["duck_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        out["status"] = "cols"
        return out
    s_types = {f.name: spark_type_as_duck(f.dataType.simpleString()) for f in df.schema.fields}
    d_types = {c[0]: str(c[1]) for c in res.description}
    diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if diff:
        out["type_diff"] = diff
    exact = _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False)
    close = exact or _rows(s_cols, s_rows, True) == _rows(d_cols, d_rows, True)
    out["status"] = "exact" if exact else ("close" if close else "DIFF")
    if not close:
        a, b = _rows(s_cols, s_rows, True), _rows(d_cols, d_rows, True)
        out["only_spark"] = list((a - b).items())[:3]
        out["only_duck"] = list((b - a).items())[:3]
    return out


def main(argv):
    from lakestrata.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    from __spark_entry__ import queries
    names = argv[2:] or list(queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on to the next query
            r = {"name": n, "status": "ERROR", "error": str(e)[:400]}
        bad += r["status"] not in ("exact", "close")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
