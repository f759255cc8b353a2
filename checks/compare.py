"""Run queries and their SQL side by side and report differences.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=key)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """Row count and a text that is empty when both results are the same."""
    columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    names, expected = _rows([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return len(got), f"columns {columns} and {names}"
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if kinds.get(kind) != types[name]:
            return len(got), f"type of {name}: {kind} and {types[name]}"
    if got != expected:
        only_got, only_expected = set(got) - set(expected), set(expected) - set(got)
        return len(got), (
            f"{len(got)} and {len(expected)} rows; only Spark {len(only_got)}: {sorted(only_got, key=str)[:3]}; "
            f"only SQL {len(only_expected)}: {sorted(only_expected, key=str)[:3]}"
        )
    return len(got), ""


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names:
        start = time.time()
        df = QUERIES[name](spark, folder)
        if name in ORACLE:
            count, problem = differences(df, con, ORACLE[name])
        else:
            count, problem = df.count(), ""
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28} {count:8} rows {time.time() - start:7.2f} s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
