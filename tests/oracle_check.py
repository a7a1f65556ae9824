"""Runs registered queries against DuckDB: ``oracle_check.py [sf_dir] [name...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(int(value))
    return repr(value) if isinstance(value, float) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(con, spark, name, query, sf_dir):
    """Empty string when equal, otherwise what differs."""
    frame = query.run(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if query.sql is None:
        return "" if got else "no rows"
    cursor = con.execute(query.sql)
    names = [c[0] for c in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(set(names) ^ set(frame.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} instead of {len(want)}"
    for ours, theirs in zip(got, want, strict=True):
        if ours != theirs:
            cells = [
                f"{c}: {a} / {b}"
                for c, a, b in zip(sorted(names), ours, theirs, strict=True) if a != b
            ]
            return "; ".join(cells)[:600]
    return "" if got else "equal but empty"


def main() -> int:
    from tillmart.plans.queries import QUERIES
    from tillmart.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            message = compare(con, spark, name, QUERIES[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:900]}"
        failed += bool(message)
        print(f"{'FAIL' if message else 'ok  '} {name} {time.time() - start:.1f}s {message}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
