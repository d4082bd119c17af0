"""Compares every registered query with its SQL on a folder of tables.

``python -m tests.oracle_check [folder] [name ...]``
"""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = pathlib.Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[k] for k in order) for row in rows), key=repr)


def difference(frame, connection, sql: str) -> str | None:
    """What differs between a Spark frame and a statement, or None."""
    found = connection.execute(sql)
    names = [column[0] for column in found.description]
    expected = sorted_rows(names, found.fetchall())
    actual = sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if repr(a) != repr(e)]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark, connection, bad = local_session(), connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            frame, sql = queries()[name](spark, folder), oracle_sql().get(name)
            # Without a statement, only that it runs.
            problem = difference(frame, connection, sql) if sql else frame.foreach(lambda row: None)
        except Exception as error:  # one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
