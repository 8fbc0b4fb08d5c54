"""Compare the registered queries with their SQL on the same Parquet tables.

    python -m tests.oracle [folder] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str | None:
    """What differs between a Spark result and a SQL result, or ``None``."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    wanted = _canonical(columns, result.fetchall())
    got = _canonical(frame.columns, [tuple(r) for r in frame.collect()])
    if got == wanted:
        return None
    extra, missing = [r for r in got if r not in set(wanted)], [r for r in wanted if r not in set(got)]
    return f"{len(got)} / {len(wanted)} rows; only Spark {extra[:3]}; only SQL {missing[:3]}"


def main() -> int:
    import __spark_entry__ as entries
    from ledgerlake.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entries.queries())
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            frame = entries.queries()[name](spark, folder)
            sql = entries.oracle_sql().get(name)
            problem = None if sql is None else differences(frame, connection, sql)
            n = frame.count()
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", "-"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28} {n:>8} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
