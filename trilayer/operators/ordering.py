"""Positions and running totals over a whole table, without a one-task window.

A global `row_number` or running sum sorts every row in a single task. Here the
table is range-sorted over all tasks and written once; each file then holds one
contiguous stretch of the order, so a row's position is the number of rows in
earlier files plus its index in its own file. Only the per-file counts, one row
per file, meet in one place.

The written table also cuts the lineage: positions are read from files that
outlive executors, so a lost task recomputes the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilayer.operators.joins import join_dimension
from trilayer.sinks.scratch import scratch_dir

_FILE, _INDEX, _TIE, _BEFORE = "_file", "_index", "_tie", "_before"
_STRETCH, _STRETCH_NO = "_stretch", "_stretch_no"
#: Rows a task of the global sort gets on average, at most.
SORT_ROWS = 1 << 21
#: Rows of a file that a running sum adds up in one window, and such blocks a task sorts.
BLOCK, TASK_BLOCKS = 1 << 16, 8


def store_sorted(
    df: DataFrame,
    order_by: Sequence[str],
    path: str | None = None,
    split_ties: bool = True,
    n_rows: int | None = None,
) -> str:
    """Write `df` in one global order and return the folder.

    `split_ties` lets a group of equal keys, however large, spread over many tasks.
    Such rows must be interchangeable, and `df` must come straight from a scan, so
    that a recomputed task repeats its ties. Turn it off where the key is unique.
    With `n_rows`, the number of rows, there are more tasks than the setting for shuffles
    says where the rows need them.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, "sorted")
    keys = list(order_by)
    tasks = -(-(n_rows or 0) // SORT_ROWS)
    number = [tasks] if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    if split_ties:
        df, keys = df.withColumn(_TIE, F.monotonically_increasing_id()), [*keys, _TIE]
    ordered = df.repartitionByRange(*number, *keys).sortWithinPartitions(*keys).drop(_TIE)
    ordered.write.mode("overwrite").parquet(path)
    return path


def _stretch_order() -> list[Column]:
    """Task number, then file number within the task, both from the name, the path, the block."""
    file = F.col(f"{_STRETCH}.{_FILE}")
    name = F.regexp_extract(file, r"([^/]+)$", 1)
    return [
        F.regexp_extract(name, r"^part-(\d+)-", 1).try_cast("bigint"),
        F.regexp_extract(name, r"-c(\d+)", 1).try_cast("bigint"),
        file,
        F.col(f"{_STRETCH}.block"),
    ]


def _with_offsets(spark: SparkSession, path: str, weight: Column, block: int | None = None) -> DataFrame:
    """Rows of a stored table with their index, the number of their stretch and the weight of
    earlier ones, null where none of it is known.

    A stretch is a file or, with `block`, so many rows of one.
    """
    index = F.col("_metadata.row_index")
    at = F.floor(index / block) if block else F.lit(0)
    rows = spark.read.parquet(path).select(
        "*",
        F.struct(F.col("_metadata.file_path").alias(_FILE), at.cast("bigint").alias("block")).alias(_STRETCH),
        index.alias(_INDEX),
    )
    per_stretch = rows.groupBy(_STRETCH).agg(F.sum(weight).alias("_weight"))
    # One row per stretch of the table, so this window stays small.
    order = Window.orderBy(*_stretch_order())
    offsets = per_stretch.select(
        _STRETCH,
        F.row_number().over(order).alias(_STRETCH_NO),
        F.sum("_weight").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias(_BEFORE),
    )
    # Stored, as it is read by the size probe and by the join.
    stored = scratch_dir(spark, "offsets")
    offsets.write.parquet(stored)
    offsets = spark.read.schema(offsets.schema).parquet(stored)
    return join_dimension(rows, offsets, _STRETCH, "inner", spread_by=[_INDEX]).drop(_STRETCH)


def number_stored_rows(spark: SparkSession, path: str, out: str = "row_no") -> DataFrame:
    """Dense positions 0..n-1 in file order. No sort and no shuffle of the rows."""
    located = _with_offsets(spark, path, F.lit(1).cast("bigint"))
    position = (F.coalesce(_BEFORE, F.lit(0)) + F.col(_INDEX)).alias(out)
    return located.withColumn(out, position).drop(_STRETCH_NO, _INDEX, _BEFORE)


def number_rows(df: DataFrame, order_by: Sequence[str], out: str = "row_no") -> DataFrame:
    """Dense positions 0..n-1 in key order, the same on any cluster."""
    return number_stored_rows(df.sparkSession, store_sorted(df, order_by), out)


def stored_running_total(
    spark: SparkSession, path: str, weight: str, out: str = "running_total"
) -> DataFrame:
    """Inclusive running sum in file order, null until the first weight.

    Blocks of rows, not files, are dealt to tasks, as many as the rows need: neither the
    size of a file nor the setting for shuffles decides what a task holds.
    """
    rows = spark.read.parquet(path).count()
    tasks = -(-rows // (BLOCK * TASK_BLOCKS)) or 1
    located = _with_offsets(spark, path, F.col(weight), BLOCK).repartition(tasks, _STRETCH_NO)
    within = Window.partitionBy(_STRETCH_NO).orderBy(_INDEX).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    so_far = F.sum(weight).over(within)
    total = F.coalesce(F.col(_BEFORE) + so_far, _BEFORE, so_far)
    return located.withColumn(out, total).drop(_STRETCH_NO, _INDEX, _BEFORE)


def running_total(
    df: DataFrame, order_by: Sequence[str], weight: str, out: str = "running_total"
) -> DataFrame:
    """Inclusive running sum of an integer column over the whole table in key order."""
    # Beside a column: Spark refuses to count lines of text by their corrupt mark alone.
    n_rows = df.agg(F.count(F.lit(1)), F.max(order_by[0])).first()[0]
    return stored_running_total(df.sparkSession, store_sorted(df, order_by, n_rows=n_rows), weight, out)
