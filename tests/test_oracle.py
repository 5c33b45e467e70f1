"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

from checks.compare import difference, duckdb_session
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_session(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, connection, sf_dir, name):
    assert difference(spark, connection, sf_dir, name) is None


def test_corrupt_lines_are_there_and_accounted_for(spark, sf_dir):
    sides = {r.side: r for r in QUERIES["corrupt_sides"](spark, sf_dir).collect()}
    assert sides["valid"].n_corrupt == 0 and sides["quarantine"].n_corrupt > 0
    lines = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert sides["valid"].n + sides["quarantine"].n == lines
