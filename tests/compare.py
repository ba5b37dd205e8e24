"""Compares registered queries with their SQL over the test tables.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    return repr(value) if isinstance(value, float) else str(value)


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> tuple[str, int]:
    df = query(spark, sf_dir)
    mine = df.collect()
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}", len(mine)
    ours, sqls = sorted_rows(df.columns, mine), sorted_rows(names, theirs.fetchall())
    if ours == sqls:
        return "", len(mine)
    only, missing = list(set(ours) - set(sqls)), list(set(sqls) - set(ours))
    return f"{len(ours)}/{len(sqls)} rows, only spark {only[:2]}, only sql {missing[:2]}", len(mine)


if __name__ == "__main__":
    import __spark_entry__ as entry

    from tests.session import local_session

    spark = local_session()
    where, picked = sys.argv[1], sys.argv[2:]
    sql = entry.oracle_sql()
    con = connect(where)
    failed = 0
    for name, query in entry.queries().items():
        if picked and name not in picked:
            continue
        started = time.time()
        try:
            problem, n = differences(spark, con, query, sql[name], where)
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", 0
        failed += bool(problem)
        mark = "FAIL" if problem else "ok  "
        print(f"{mark} {name} {n} rows {time.time() - started:.2f}s {problem}", flush=True)
    print("failed:", failed)
