"""Registered queries against their SQL: ``python -m tests.compare [sf] [names...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry_point

TABLES = "region nation customer supplier part orders lineitem".split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def spark_result(df) -> tuple[list[str], Counter]:
    return _bag(df.columns, df.collect())


def oracle_result(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    return _bag([d[0] for d in cursor.description], cursor.fetchall())


def main() -> None:
    from retrocohort.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entry_point.QUERIES)
    folder = f"/root/testdata/sf{sf}"
    spark = build_session()
    connection = oracle_connection(folder)
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    for name in names:
        began = time.time()
        try:
            got = spark_result(queries[name](spark, folder))
            took = time.time() - began
            want = oracle_result(connection, oracles[name])
        except Exception as error:  # noqa: BLE001
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:1500]}")
            continue
        verdict = "ok   " if got == want else "DIFF "
        print(f"{verdict}{name}: {sum(got[1].values())} rows, {took:.2f}s", flush=True)
        if got != want:
            print("  spark only:", got[0], list((got[1] - want[1]).items())[:3])
            print("  sql only:  ", want[0], list((want[1] - got[1]).items())[:3])
    spark.stop()


if __name__ == "__main__":
    main()
