"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.publish import settle

SIDE, VALID_SIDE, QUARANTINE_SIDE = "side", "valid", "quarantine"


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet table with its partition columns taken from the folder names.

    Pass the schema for tables that may be empty: they have no file to read it from.
    """
    settle(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_side(spark: SparkSession, path: str, side: str) -> DataFrame:
    """One side of a split table; the other side's folders are pruned.

    The side may be empty: the schema comes from the table as a whole.
    """
    settle(spark, path)
    return spark.read.parquet(path).filter(F.col(SIDE) == side).drop(SIDE)
