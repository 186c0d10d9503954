"""Runs registered queries next to their SQL in DuckDB and compares all values.

``python -m tests.oracle [--sf 0.01] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, list | tuple):
        return [_plain(v) for v in value]
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(repr(_plain(row[i])) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain)


def spark_result(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    return _sorted([d[0] for d in cursor.description], cursor.fetchall())


def differences(df, con, sql) -> str | None:
    """None when both sides agree, else what is different."""
    columns, rows = spark_result(df)
    expected_columns, expected = duck_result(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    bad = [(a, b) for a, b in zip(rows, expected, strict=True) if a != b]
    if bad:
        a, b = bad[0]
        pairs = [(c, x, y) for c, x, y in zip(columns, a, b, strict=True) if x != y]
        return f"{len(bad)} of {len(rows)} rows differ, first: {pairs[:5]}"
    return None


def main() -> int:
    from lakecast import build_session
    from lakecast.queries import registry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = str(TESTDATA / f"sf{args.sf}")
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, query in registry().items():
        if args.names and name not in args.names:
            continue
        started = time.time()
        try:
            df = query.run(spark, sf_dir)
            if query.sql is None:
                problem, note = None, f"{len(df.collect())} rows, no SQL"
            else:
                problem, note = differences(df, con, query.sql), f"{df.count() if args.names else ''}"
        except Exception as error:
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
