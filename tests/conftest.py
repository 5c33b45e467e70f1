from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("trilayer-tests")
        .config("spark.sql.shuffle.partitions", 8)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", False)
        .config("spark.driver.memory", "6g")
        .config("spark.python.sql.dataFrameDebugging.enabled", False)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples; nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is not None, v) for v in r])


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
