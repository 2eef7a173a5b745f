"""Compare registered queries with their oracle SQL: names, types, rows, exact values.

Run as a script for a report: ``python tests/oracle_check.py [folder] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else a text that says what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    for name, dtype in df.dtypes:
        if _KIND.get(dtype) != types[name]:
            return f"type of {name}: {dtype} against {types[name]}"
    got = _rows(df.columns, df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"first difference: {a} against {b}"
    return None


if __name__ == "__main__":
    from claimloom.oracles import ORACLES
    from claimloom.queries import QUERIES
    from claimloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), connect(folder)
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                verdict = difference(df, con, ORACLES[name]) or "equal"
            else:
                verdict = f"{df.count()} rows, no oracle"
        except Exception as error:  # report and go on
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.2f}s  {verdict}", flush=True)
