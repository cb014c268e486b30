"""Run registered queries and their SQL side by side.

    python -m tests.oracle [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

from suite import registry
from tidemark.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    check = registry.CHECKS[name]
    df = check.query(spark, sf_dir)
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    if not check.sql:
        return None if left else "no rows"
    cursor = con.execute(check.sql)
    columns = [c[0] for c in cursor.description]
    right = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if repr(a) != repr(b):
            return f"{sorted(columns)}\n  spark {a}\n  sql   {b}"
    return None if left else "equal but empty"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con, bad = local_session(8), connect(args.sf), 0
    for name in args.names or registry.CHECKS:
        start = time.time()
        try:
            problem = compare(spark, con, name, args.sf)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql" if registry.CHECKS[name].sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {kind} {name} {problem or ''}", flush=True)
    print(f"{bad} of {len(args.names or registry.CHECKS)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
