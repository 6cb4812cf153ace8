"""Run registered queries against their oracles: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from aquifold.session import build_session
from checks import oracles, registry

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, folder: str, name: str) -> str:
    """Empty if both sides agree exactly, else what differs first."""
    df = registry.queries()[name](spark, folder)
    mine = _rows(df.columns, df.collect())
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        return "" if mine else "no rows"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    differing = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if differing:
        return f"{len(differing)} of {len(mine)} rows differ, first {differing[0][0]} vs {differing[0][1]}"
    return ""


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        master="local[8]", shuffle_partitions=8, spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in names or list(registry.queries()):
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        kind = "oracle" if name in oracles.ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:6} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{failures} failures")
    return int(failures > 0)


if __name__ == "__main__":
    given = sys.argv[1:]
    folder = given.pop(0) if given and Path(given[0]).is_dir() else "/root/testdata/sf0.01"
    raise SystemExit(main(folder, given))
