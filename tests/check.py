"""Compare registered queries with their SQL: python tests/check.py [sf_dir] [names...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def spark_kind(t: str) -> str:
    return {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE"}.get(t, t.upper())


def compare(spark, con, sf_dir, name, query, sql) -> str:
    df = query(spark, sf_dir)
    got = canonical(df.columns, df.collect())
    rel = con.sql(sql)
    want = canonical(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    kinds = {c: spark_kind(t) for c, t in df.dtypes}
    wanted = dict(zip(rel.columns, map(str, rel.types)))
    off = {c: (kinds[c], wanted[c]) for c in kinds if kinds[c] != wanted[c]}
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}"
    if off:
        return f"types differ: {off}"
    if not got[1]:
        return "no rows"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallyfold.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        t0 = time.time()
        try:
            if name in oracle:
                note = compare(spark, con, sf_dir, name, query, oracle[name])
            else:
                note = "" if query(spark, sf_dir).count() else "no rows"
        except Exception as e:
            note = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - t0:.1f}s {note}", flush=True)
    print("failed:", failed)
