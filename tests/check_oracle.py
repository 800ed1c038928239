"""Compare registered queries with DuckDB: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = sorted(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], table


def compare(spark, connection, name: str, folder: str) -> str:
    """An empty string if the two agree, else the difference."""
    import __spark_entry__ as registered

    result = registered.queries()[name](spark, folder)
    got = normal(result.columns, [tuple(row) for row in result.collect()])
    cursor = connection.execute(registered.oracle_sql()[name])
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(wrong)} rows differ, such as {wrong[0]}" if wrong else ""


def main() -> None:
    from wayfare.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    import __spark_entry__ as registered

    names = sys.argv[2:] or list(registered.queries())
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("CHECK_PARTITIONS", "8"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = duck(folder)
    for name in names:
        begun = time.time()
        try:
            difference = compare(spark, connection, name, folder)
        except Exception as error:  # keep going: report every query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:34} {time.time() - begun:6.1f}s {difference or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
