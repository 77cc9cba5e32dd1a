"""Run registered queries beside their SQL: python tests/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, float):
        return repr(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, sf: str, name: str, fn, sql: str) -> str | None:
    df = fn(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if got != want:
        extra, short = got - want, want - got
        return f"{sum(got.values())} rows against {sum(want.values())}; {sum(extra.values())} differ: {list(extra)[:3]} / {list(short)[:3]}"
    return None if want else "no rows"


def main() -> int:
    import __spark_entry__ as e
    from tidemark.session import local_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark, con, bad = local_session(8), connect(sf), 0
    oracles = e.oracle_sql()
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                message = difference(spark, con, sf, name, fn, oracles[name]) or "ok"
            else:
                message = f"rows {fn(spark, sf).count()}"
        except Exception as error:
            message = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not message.startswith(("ok", "rows "))
        print(f"{name:28s} {time.time() - start:6.2f}s  {message}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
