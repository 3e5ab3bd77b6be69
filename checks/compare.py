"""Runs every registered query beside its SQL and compares columns, types and rows.

``python -m checks.compare [folder] [name ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import oracle, registry
from voltatlas.session import build_session

# Spark types and the DuckDB types they must meet.
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str, sql: str) -> str:
    """Empty when both sides agree, else what differs first."""
    df = registry.all_queries()[name](spark, folder)
    found = {column: TYPES.get(kind, kind) for column, kind in df.dtypes}
    rows = [tuple(row[c] for c in sorted(found)) for row in df.collect()]
    answer = con.execute(sql)
    expected = {column[0]: str(column[1]) for column in answer.description}
    if found != expected:
        return f"columns {found} expected {expected}"
    names = list(expected)
    other = [tuple(row[names.index(c)] for c in sorted(names)) for row in answer.fetchall()]
    if len(rows) != len(other):
        return f"{len(rows)} rows, expected {len(other)}"
    rows, other = (sorted(side, key=lambda r: tuple((v is None, str(v)) for v in r)) for side in (rows, other))
    for mine, theirs in zip(rows, other):
        if mine != theirs:
            return f"row {mine} expected {theirs}"
    return ""


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, texts, bad = connect(folder), oracle.oracle_sql(), 0
    for name in sys.argv[2:] or registry.all_queries():
        started = time.time()
        try:
            problem = difference(spark, con, folder, name, texts[name]) if name in texts else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
