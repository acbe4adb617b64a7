"""Run registered queries next to their SQL text and compare the results value by value.

    python -m tests.compare /root/testdata/sf0.01 [key-prefix ...]
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

from riskmart.adapters import TABLES


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    problems = []
    if got_cols != want_cols:
        problems.append(f"columns {got_cols} <> {want_cols}")
    if sum(got.values()) != sum(want.values()):
        problems.append(f"rows {sum(got.values())} <> {sum(want.values())}")
    if got != want:
        problems.append(f"only here: {list((got - want).items())[:3]}  only SQL: {list((want - got).items())[:3]}")
    return problems


def main() -> int:
    from riskmart.queries import ORACLE, QUERIES
    from riskmart.session import local_session

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    bad = 0
    for key, fn in QUERIES.items():
        if prefixes and not key.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if key in ORACLE:
                problems = compare(df, con, ORACLE[key])
                note = "ok"
            else:
                problems, note = [], f"rows only: {len(df.collect())}"
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        print(f"{key:34s} {time.time() - start:6.2f}s", "; ".join(problems) or note, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
