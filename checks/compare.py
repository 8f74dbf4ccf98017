"""Compare registered queries with their SQL: ``python -m checks.compare SF_DIR [name…]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(found: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` if both give the same columns and rows, else what differs first."""
    result = connection.execute(sql)
    expected_columns = [column[0] for column in result.description]
    if sorted(expected_columns) != sorted(found.columns):
        return f"columns {found.columns} instead of {expected_columns}"
    expected = rows_of(expected_columns, result.fetchall())
    actual = rows_of(found.columns, found.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    for ours, theirs in zip(actual, expected):
        if ours != theirs:
            return f"{str(ours)[:600]}\n  instead of\n  {str(theirs)[:600]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = difference(frame, connection, ORACLES[name])
                verdict = "same" if problem is None else f"DIFFERENT {problem}"
            else:
                problem, verdict = None, f"{frame.count()} rows"
        except Exception as error:  # a report of all queries, not only up to the first failure
            problem = verdict = f"FAILED {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
