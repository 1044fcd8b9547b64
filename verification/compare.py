"""Run the queries and their SQL side by side: ``python -m verification.compare SF_DIR [KEY ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracle import ORACLE_SQL
from verification.queries import portable_queries


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def _cell(value: object) -> object:
    """Numbers as exact doubles, NaN as None, anything else as is."""
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, int):
        return float(value)
    return value


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_result: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """What differs, or None. Columns by name, rows as a multiset, values exactly."""
    got = [tuple(row) for row in spark_result.collect()]
    relation = connection.execute(sql)
    names = [column[0] for column in relation.description]
    want = relation.fetchall()
    if sorted(spark_result.columns) != sorted(names):
        return f"columns {sorted(set(spark_result.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    left, right = _rows(spark_result.columns, got), _rows(names, want)
    if left == right:
        return None
    only_spark, only_sql = left - right, right - left
    return f"{sum(only_spark.values())} rows differ, e.g. {next(iter(only_spark))} / {next(iter(only_sql))}"[:600]


def run(spark: SparkSession, sf_dir: str, keys: list[str]) -> int:
    connection, failures = duckdb_on(sf_dir), 0
    for name, query in portable_queries().items():
        if keys and name not in keys:
            continue
        start = time.time()
        problem = difference(query(spark, sf_dir), ORACLE_SQL[name], connection)
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    from mensario.session import local_session

    sys.exit(1 if run(local_session(8), sys.argv[1], sys.argv[2:]) else 0)
