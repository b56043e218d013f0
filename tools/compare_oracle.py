"""Run every catalog query in Spark and its oracle in DuckDB; report mismatches.

Compares column names, column types (Spark type mapped to DuckDB's) and the
values exactly, order-insensitively. ``--round N`` compares doubles rounded
to N places instead.

Usage: python tools/compare_oracle.py [--round N] [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stockledger.config import build_session  # noqa: E402
from stockledger.plans.catalog import queries  # noqa: E402
from stockledger.plans.oracle_sql import oracle_sql  # noqa: E402

TABLES = ("part", "lineitem", "orders")


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "double": "DOUBLE", "string": "VARCHAR"}
ROUND: int | None = None


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, ROUND) if ROUND is not None else v
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


def main(argv):
    global ROUND
    if argv[:1] == ["--round"]:
        ROUND, argv = int(argv[1]), argv[2:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sql = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        cols = sorted(df.columns)
        srows = _rows(df.select(*cols).collect())
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:28s} spark={len(srows):8d} (no oracle) {ts:.2f}s")
            continue
        t0 = time.time()
        rel = con.sql(sql[name])
        ocols = sorted(rel.columns)
        stypes = {c: TYPES.get(t, t) for c, t in df.dtypes}
        otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        orows = _rows(con.sql(f"SELECT {', '.join(chr(34)+c+chr(34) for c in ocols)} FROM ({sql[name]})").fetchall())
        to = time.time() - t0
        ok = cols == ocols and srows == orows and stypes == otypes
        bad += not ok
        print(f"{name:28s} spark={len(srows):8d} duck={len(orows):8d} {'OK ' if ok else 'BAD'} {ts:.2f}s/{to:.2f}s")
        if not ok:
            if cols != ocols or stypes != otypes:
                print("   cols", cols, ocols)
                print("   spark types", stypes, "duck types", otypes)
            else:
                so, oo = set(srows), set(orows)
                print("   spark-only", list(so - oo)[:3])
                print("   duck-only ", list(oo - so)[:3])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
