"""Writing tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.operators.quality import VALID
from trilayer.publish import PARTS, promote, replacing
from trilayer.sources.tables import QUARANTINE_SIDE, SIDE, VALID_SIDE

log = logging.getLogger(__name__)


def write_landing(df: DataFrame, path: str, sep: str = ";") -> None:
    """Raw text with a header, white space kept as it is."""
    writer = (
        df.write.option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    with replacing(df.sparkSession, path) as staged:
        writer.csv(staged)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] | None = None,
    cluster: bool = False,
    max_records_per_file: int = 0,
    mode: str = "overwrite",
) -> None:
    """Parquet, partitioned by the given columns that exist. The old table stays until the
    new one is whole; other modes than "overwrite" write in place.

    `cluster` shuffles rows by partition value so that a small table gets one file
    per value. It is a rebalance, not a hash repartition: a value holding most of
    the rows is split into files of the advisory size instead of filling one task.
    Leave it off where the scan already delivers rows by partition value, as the
    yearly landing folders do: then no shuffle is needed at all.
    """
    asked = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    keys = [c for c in asked if c in df.columns]
    if cluster and keys:
        df = df.hint("rebalance", *keys)
    writer = df.write.option("maxRecordsPerFile", max_records_per_file)
    if keys:
        writer = writer.partitionBy(*keys)
    if mode != "overwrite":
        writer.mode(mode).parquet(path)
        return
    with replacing(df.sparkSession, path) as staged:
        writer.parquet(staged)


def replace_partition(
    df: DataFrame,
    path: str,
    partition_by: str,
    value: int | None = None,
    cluster: bool = False,
) -> None:
    """Overwrite some partitions of a table and leave the others alone.

    Without `value` these are the partitions that `df` holds rows for. With it, it is
    that one partition, even if `df` has no row for it: then it becomes empty. A row
    that belongs elsewhere, or nowhere, fails the call before anything is written.
    """
    if value is not None:
        if df.filter(~F.col(partition_by).eqNullSafe(F.lit(value))).limit(1).count():
            raise ValueError(f"rows of other partitions than {partition_by}={value}")
        part = df.drop(partition_by)
        part = part.hint("rebalance") if cluster else part
        with replacing(df.sparkSession, f"{path}/{partition_by}={value}") as staged:
            part.write.parquet(staged)
        return
    if cluster:
        df = df.hint("rebalance", partition_by)
    with replacing(df.sparkSession, path, PARTS) as staged:
        df.write.partitionBy(partition_by).parquet(staged)


@dataclass(frozen=True)
class SplitTotals:
    total: int
    good: int
    bad: int


def split_write(
    df: DataFrame,
    path: str,
    partition_by: str = "yr",
    on_zero_valid: str = "both",
    cluster: bool = False,
    flag: str = VALID,
) -> SplitTotals:
    """Write valid and quarantined rows in one pass, the flag turned into folders.

    `path/side=valid/...` and `path/side=quarantine/...` come from a single scan of
    the input, with nothing cached. The totals are then counted from the written
    files, whose footers hold the row counts, so they are exact even if tasks of
    the write were retried.

    If no row is valid and `on_zero_valid` is "both", all rows go to both sides. The table
    takes its place when all of that is written; until then the old one stays.
    """
    if on_zero_valid not in ("both", "quarantine"):
        raise ValueError(f"unknown policy: {on_zero_valid}")
    spark = df.sparkSession
    side = F.when(F.col(flag), F.lit(VALID_SIDE)).otherwise(F.lit(QUARANTINE_SIDE))
    sided = df.withColumn(SIDE, side).drop(flag)
    with replacing(spark, path) as staged:
        first = f"{staged}/first"
        write_table(sided, first, [SIDE, partition_by], cluster, mode="errorifexists")
        written = spark.read.schema(sided.schema).parquet(first)
        counted = written.agg(
            F.count(F.lit(1)).alias("total"), F.count_if(F.col(SIDE) == VALID_SIDE).alias("good")
        ).first()
        total, good = counted["total"], counted["good"]
        kept = first
        if total and not good and on_zero_valid == "both":
            log.warning("no valid rows: writing all %d rows to both sides", total)
            both = F.explode(F.array(F.lit(VALID_SIDE), F.lit(QUARANTINE_SIDE)))
            kept = f"{staged}/both"
            write_table(written.withColumn(SIDE, both), kept, [SIDE, partition_by], mode="errorifexists")
        promote(spark, kept, staged)
    return SplitTotals(total, good, total - good)


METADATA_SCHEMA = T.StructType(
    [
        T.StructField("seed", T.LongType()),
        T.StructField("growth", T.DoubleType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("n_generated", T.LongType()),
        T.StructField("n_corrupt", T.LongType()),
        T.StructField("day_codes", T.ArrayType(T.IntegerType())),
        T.StructField("target_weather", T.ArrayType(T.IntegerType())),
        T.StructField("target_light", T.ArrayType(T.IntegerType())),
        T.StructField("target_zone", T.ArrayType(T.StringType())),
        T.StructField("source", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)


def write_run_metadata(spark: SparkSession, record: Mapping[str, object], path: str) -> None:
    """One JSON record that says how a scenario was made."""
    row = tuple(record.get(field.name) for field in METADATA_SCHEMA.fields)
    with replacing(spark, path) as staged:
        spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1).write.json(staged)
