"""Small helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.sinks.scratch import scratch_dir


#: A writing task holds a row group in memory.
ROW_GROUP_BYTES = 32 << 20


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: lineage ends at files
    that outlive executors, and each row is computed once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Remove stored tables that no later job reads."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROW = "_row"


def located(docs: DataFrame) -> DataFrame:
    """`docs` with a column `ROW` that names each row by its file and its place there.

    The name stays the same however often and with however many tasks the files are read.
    Rows that are not read straight from Parquet files are stored first.
    """
    name = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index")
    ).alias(ROW)
    every = [F.col(f"`{c}`") for c in docs.columns]
    try:
        return docs.select(*every, name)
    except AnalysisException:
        return store(docs, "located").select(*every, name)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches cut small, so that what a task derives from one stays small too."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


#: Bits of the filters below: 8 MB, however large the corpus is.
FILTER_BITS = 1 << 26


def bit_filter(positions: DataFrame) -> np.ndarray:
    """The `FILTER_BITS` bits as 64-bit words, those at the one column's positions set."""
    at = F.col(f"`{positions.columns[0]}`")
    rows = (
        positions.select((at / 64).cast("long").alias("word"), (at % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("mask"))
        .toArrow()
    )
    mask = np.zeros(FILTER_BITS // 64, np.uint64)
    mask[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return mask


def bits_at(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (mask[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def without_rows(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """`located` rows less those named in `gone`, as they were before they were located."""
    return rows.join(store(gone.select(ROW), "gone"), ROW, "left_anti").drop(ROW)
