"""Run registered queries against their SQL twins and report differences.

Usage: python -m checks.compare SF_DIR [NAME ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracle import ORACLES
from checks.registry import QUERIES
from tickloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _normal(value):
    if isinstance(value, float):
        return f"{value:.9g}" if math.isfinite(value) else str(value)
    return str(value)


def rows_by_name(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_normal(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """A description of the first difference, or None."""
    df = QUERIES[name](spark, sf_dir)
    actual = rows_by_name(df.columns, df.collect())
    if name not in ORACLES:
        return None
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = rows_by_name(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for got, wanted in zip(actual, expected):
        if got != wanted:
            return f"\n  got      {got}\n  expected {wanted}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                              "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
