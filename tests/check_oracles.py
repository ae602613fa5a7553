"""Run registered queries against their SQL oracles: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float):
        return round(value, 6)
    return value


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    """(matches, message) for one query."""
    start = time.time()
    df = fn(spark, sf_dir)
    mine = normal([tuple(r) for r in df.collect()], df.columns)
    took = time.time() - start
    if sql is None:
        return bool(mine), f"{len(mine)} rows, no oracle, {took:.1f}s"
    start = time.time()
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = normal(cursor.fetchall(), columns)
    note = f"{len(mine)} rows, spark {took:.1f}s, duckdb {time.time() - start:.1f}s"
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    if mine != theirs:
        extra = [r for r in mine if r not in set(theirs)][:3]
        missing = [r for r in theirs if r not in set(mine)][:3]
        return False, f"{note}; {len(theirs)} expected; extra {extra} missing {missing}"
    return True, note


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from lotweave.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session, connection = local_session("8"), connect(folder)
    oracles, bad = oracle_sql(), 0
    for query_name, query_fn in queries().items():
        if wanted and query_name not in wanted:
            continue
        try:
            ok, message = compare(session, connection, query_name, query_fn, oracles.get(query_name), folder)
        except Exception as problem:  # noqa: BLE001
            ok, message = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", query_name, message, flush=True)
    print("failures:", bad)
