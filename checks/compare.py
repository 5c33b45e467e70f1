"""Run queries and oracles side by side: `python -m checks.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duckdb_session(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    """Rows as text in column-name order, sorted; values compared exactly."""
    columns = sorted(frame.columns)

    def text(value: object) -> str:
        return "NULL" if value is None or value is pd.NA or value != value else repr(value)

    rows = frame[columns].astype(object).itertuples(index=False, name=None)
    return sorted(tuple(text(v) for v in row) for row in rows)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None if the query equals its oracle, else what differs."""
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = connection.execute(ORACLE_SQL[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} and {len(theirs)}"
    for frame in (ours, theirs):
        for column in frame.columns:
            kind = frame[column].dtype
            if pd.api.types.is_bool_dtype(kind):
                frame[column] = frame[column].map(bool)
            elif pd.api.types.is_numeric_dtype(kind):
                frame[column] = frame[column].astype(float)
    for mine, other in zip(canonical(ours), canonical(theirs)):
        if mine != other:
            return f"row {mine} and {other}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", 8)
        .config("spark.ui.enabled", False)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_session(sf_dir)
    failures = 0
    for name in names:
        start = time.perf_counter()
        try:
            if name in ORACLE_SQL:
                verdict = difference(spark, connection, sf_dir, name) or "ok"
            else:
                verdict = f"rows only: {QUERIES[name](spark, sf_dir).count()}"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failures += not (verdict == "ok" or verdict.startswith("rows only"))
        print(f"{name:24s} {time.perf_counter() - start:6.2f}s  {verdict}", flush=True)
    print(f"{failures} failures of {len(names)}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
