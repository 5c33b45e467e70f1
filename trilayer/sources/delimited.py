"""Tolerant reading of delimited text: all strings, corrupt lines kept, lineage added."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.config import SourceSpec
from trilayer.operators.quality import CORRUPT_RECORD
from trilayer.operators.typing import stripped_names
from trilayer.publish import settle

log = logging.getLogger(__name__)

SOURCE_FILE, INGEST_TS, MARKER = "source_file", "ingest_ts", "scenario"
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _reader(spark: SparkSession, sep: str, recursive: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("recursiveFileLookup", recursive)
        .option("pathGlobFilter", "*.csv")
    )


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    sep: str = ";",
    run_ts: datetime | None = None,
    recursive: bool = True,
) -> DataFrame:
    """Every `*.csv` under `path` as strings, plus corrupt record, file and run time.

    `columns` are the header names as they stand in the files; without them the
    first header found is read. Files whose header differs fail the read rather
    than land in the wrong columns: give each layout its own source. Spark refuses
    queries that use the corrupt record and no other column; add one.
    """
    settle(spark, path)
    if columns is None:
        columns = _reader(spark, sep, recursive).csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in columns]
    raw = (
        _reader(spark, sep, recursive)
        .schema(T.StructType([*fields, T.StructField(CORRUPT_RECORD, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        # With pruning, a query over few columns would see no corrupt lines.
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    named = [
        F.col(f"`{old}`").alias(new) for old, new in zip(columns, stripped_names(columns))
    ]
    return with_lineage(raw, run_ts).select(*named, CORRUPT_RECORD, SOURCE_FILE, INGEST_TS)


def with_lineage(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Source file and one ingest time for the whole run. `df` must be a file scan."""
    stamp = run_ts or datetime.now(timezone.utc)
    return df.withColumns({SOURCE_FILE: F.col("_metadata.file_path"), INGEST_TS: F.lit(stamp)})


def _first_present(
    spark: SparkSession, spec: SourceSpec, sep: str, run_ts: datetime | None
) -> DataFrame | None:
    for path in spec.paths:
        try:
            df = read_delimited(spark, path, sep=sep, run_ts=run_ts)
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
            continue
        return df.withColumn(MARKER, F.lit(spec.label)) if spec.label else df
    return None


def read_sources(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    sep: str = ";",
    run_ts: datetime | None = None,
) -> DataFrame:
    """Union by name of the sources that exist; a missing required one fails.

    One scan per source, each with its own header, and one run time for all.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    union: DataFrame | None = None
    for spec in specs:
        df = _first_present(spark, spec, sep, run_ts)
        if df is None:
            if spec.required:
                raise FileNotFoundError(f"required source not found: {spec.paths}")
            log.warning("optional source not found, skipped: %s", spec.paths)
            continue
        union = df if union is None else union.unionByName(df, allowMissingColumns=True)
    if union is None:
        raise FileNotFoundError("no source found")
    return union
