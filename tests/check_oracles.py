"""Compare registered queries with their oracles: ``python tests/check_oracles.py [sf_dir] [names…]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, fn, sql: str | None, sf_dir: str, inspect=None) -> str:
    """Empty text if the query agrees with its oracle as a multiset of rows."""
    df = fn(spark, sf_dir)
    if inspect is not None:
        inspect(df)
    names = sorted(df.columns)
    got = sorted(map(repr, (tuple(r[c] for c in names) for r in df.select(*names).collect())))
    if sql is None:
        return "" if got else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} != {sorted(rel.columns)}"
    want = sorted(map(repr, rel.select(*[f'"{n}"' for n in names]).fetchall()))
    if got != want:
        extra, missing = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows != {len(want)}; only here {list(extra)[:2]}; only in oracle {list(missing)[:2]}"
    return "" if got else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con, sqls, bad = local_session(), connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, fn, sqls.get(name), sf_dir)
        except Exception as e:
            problem = "".join(traceback.format_exception_only(e))[:600]
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name} {time.time() - start:.2f}s {'' if name in sqls else '(rows only) '}{problem}", flush=True)
    print(f"{bad} bad")
    sys.exit(bool(bad))
