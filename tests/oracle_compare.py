"""Compare catalog queries with their SQL oracle (DuckDB) on one folder.

Usable from pytest and as a script: ``python tests/oracle_compare.py [names]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(spark, con, name: str, builder, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = builder(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(_norm(v) for _, v in sorted(zip(d_cols, r))) for r in res.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} sql={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} sql={len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ ({sorted(s_cols)}): spark-only={only_s} sql-only={only_d}"
    return True, f"{len(s_rows)} rows"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from starloom.plans.catalog import queries
    from starloom.plans.oracle import oracle_sql
    from starloom.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    names = argv or list(qs)
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"SKIP {n}: no oracle", flush=True)
            continue
        try:
            ok, msg = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n}: {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
