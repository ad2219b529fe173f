"""Compare registered queries with their SQL: python tests/oracle_check.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from cardwarden.session import local_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        table = name.removesuffix(".parquet")
        files = f"{sf_dir}/{name}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{name}") else "")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """Empty when columns and rows agree, as bags; else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    result = connection.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    if columns != sorted(result.columns):
        return f"columns {columns} against {sorted(result.columns)}"
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    theirs = Counter(result.select(*(f'"{c}"' for c in columns)).fetchall())
    if ours == theirs:
        return ""
    return (
        f"{ours.total()} rows against {theirs.total()};"
        f" only ours {list((ours - theirs).items())[:3]};"
        f" only theirs {list((theirs - ours).items())[:3]}"
    )


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(entry.oracle_sql())
    spark, connection = local_session(8), duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        difference = compare(spark, connection, sf_dir, name)
        failed += bool(difference)
        print(f"{name:32} {time.time() - start:6.2f}s {difference or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
