"""Runs registered queries next to DuckDB and reports differences.

    python tests/compare.py [prefix ...] [--sf 0.01]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path[:0] = [str(Path(__file__).resolve().parents[1])]

import __spark_entry__ as catalog  # noqa: E402
from tidemark.sources.tables import SCHEMAS  # noqa: E402


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, root, name, fn, sql):
    """Returns (verdict, detail)."""
    df = fn(spark, root)
    cols, rows = canon(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return ("rows", f"{len(rows)} rows")
    cur = con.execute(sql)
    want_cols, want = canon([d[0] for d in cur.description], cur.fetchall())
    if cols != want_cols:
        return ("FAIL", f"columns {cols} != {want_cols}")
    if len(rows) != len(want):
        return ("FAIL", f"{len(rows)} rows, want {len(want)}")
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    if bad:
        return ("FAIL", f"{len(bad)} rows differ, first {bad[0][0]} != {bad[0][1]}")
    return ("ok" if rows else "EMPTY", f"{len(rows)} rows")


def main():
    from tidemark.runtime import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("prefix", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--only-bad", action="store_true")
    args = parser.parse_args()
    spark, root = local_session(), f"/root/testdata/sf{args.sf}"
    con, sqls, bad = duck(root), catalog.oracle_sql(), 0
    for name, fn in catalog.queries().items():
        if args.prefix and not any(name.startswith(p) for p in args.prefix):
            continue
        start = time.time()
        try:
            verdict, detail = compare(spark, con, root, name, fn, sqls.get(name))
        except Exception as exc:  # report and go on
            verdict, detail = "ERROR", f"{type(exc).__name__}: {str(exc)[:500]}"
        bad += verdict in ("FAIL", "ERROR", "EMPTY")
        if not args.only_bad or verdict in ("FAIL", "ERROR", "EMPTY"):
            print(f"{verdict:6}{time.time() - start:6.2f}s {name}: {detail}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
