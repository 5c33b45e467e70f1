from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import DataFrame

ROOT = str(Path(__file__).resolve().parents[2])
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tokens string, node string, size string"

LONG = " ".join(f"w{i % 977} of the {i}" for i in range(40_000))
MESSY = [
    (1, "the quick brown fox jumps over the lazy dog again", "en", "src0"),
    (1, "the quick brown fox jumps over the lazy dog again", "en", "src0"),
    (2, "The Quick brown fox jumps over the lazy dog again", "de", "src1"),
    (3, None, None, None),
    (4, "", "fr", "src0"),
    (5, "   \t\n ", "fr", "src0"),
    (6, "two words", "es", "src2"),
    (7, "two words", "es", None),
    (8, LONG, "en", "src0"),
    (9, LONG + " end", "en", "src0"),
    (None, "two words", "en", "src1"),
    (None, None, None, None),
    (10, "ünïcödé — 日本語 text \U0001f600 " * 5, "xx", "src3"),
]


@pytest.fixture(scope="session", autouse=True)
def workers_import_the_library(spark):
    environment = spark.sparkContext.environment
    environment["PYTHONPATH"] = os.pathsep.join([ROOT, environment.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def messy(spark) -> DataFrame:
    """Nulls, empty and very long texts, repeated rows, and columns named as inner ones are."""
    return spark.createDataFrame([(*r, 0, "x", "y", "z") for r in MESSY], DOCS)


@pytest.fixture(scope="session")
def empty(spark) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def by_id(rows, column):
    return {r[column]: r for r in rows}
