"""Runs registered queries beside their SQL and compares rows, order aside."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v).__name__ == "str"), v if v is not None else 0) for v in row)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple("" if v is None else repr(v) for v in r))


def compare(con, df, sql: str) -> str | None:
    """None when equal, else what differs."""
    columns = sorted(df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}"
    at = [names.index(c) for c in columns]
    want = _sorted([tuple(r[i] for i in at) for r in cur.fetchall()])
    got = _sorted([tuple(r) for r in df.select(*[df[c] for c in columns]).collect()])
    if len(want) != len(got):
        return f"rows {len(got)} vs {len(want)}"
    if want != got:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0][0]} vs {bad[0][1]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from curbflow.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        t = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = compare(con, df, sql) if sql else f"no SQL, {df.count()} rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - t:.2f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(names)} differ")
