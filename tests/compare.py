"""Run named queries and their check SQL side by side and compare rows exactly."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_frame, connection, sql: str) -> list[str]:
    """Empty when schema and rows agree."""
    relation = connection.execute(sql)
    described = [(d[0], str(d[1])) for d in relation.description]
    expected_rows = relation.fetchall()
    expected_types = {name: kind for name, kind in described}
    actual_types = {name: KINDS.get(kind, kind) for name, kind in spark_frame.dtypes}
    found = []
    if actual_types != expected_types:
        wrong = {k: (actual_types.get(k), expected_types.get(k)) for k in {*actual_types, *expected_types}
                 if actual_types.get(k) != expected_types.get(k)}
        found.append(f"schema (spark, sql): {wrong}")
    names = sorted(expected_types)
    if set(names) - set(actual_types):
        return found
    order = [[n for n, _ in described].index(n) for n in names]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in expected_rows)
    actual = Counter(tuple(_plain(row[n]) for n in names) for row in spark_frame.collect())
    if actual != expected:
        found.append(f"rows: spark={sum(actual.values())} sql={sum(expected.values())}")
        for label, extra in (("only spark", actual - expected), ("only sql", expected - actual)):
            for row in sorted(extra, key=str)[:2]:
                found.append(f"{label}: {dict(zip(names, row, strict=True))}")
    return found


def main(directory: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from paygrain.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    oracle, failures = oracle_sql(), 0
    for name, run in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            frame = run(spark, directory)
            found = differences(frame, connection, oracle[name]) if name in oracle else [f"rows only: {frame.count()}"]
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        ok = not found or found[0].startswith("rows only")
        failures += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s", *found, sep="\n      " if found else " ", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
