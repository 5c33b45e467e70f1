from __future__ import annotations

from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from trilayer.operators import joins, ordering


def hot_table(spark, partitions=16):
    """A third of all rows are copies of one row."""
    return spark.range(0, 9000, 1, partitions).selectExpr(
        "if(id % 3 = 0, 42, cast(id * 7919 % 10007 as int)) as k"
    )


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_positions_are_the_sorted_order(spark, partitions):
    df = hot_table(spark, partitions)
    got = rows(ordering.number_rows(df, ["k"]), "row_no", "k")
    assert got == list(enumerate(sorted(r.k for r in df.collect())))


def test_copies_spread_over_many_tasks(spark):
    stored = spark.read.parquet(ordering.store_sorted(hot_table(spark).repartition(16), ["k"]))
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        path = ordering.store_sorted(hot_table(spark), ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert stored.count() == 9000
    sizes = [
        r["count"]
        for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()
    ]
    assert len(sizes) == 8 and max(sizes) < 9000 / 4


def test_several_files_per_task_keep_their_order(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        df = hot_table(spark)
        got = rows(ordering.number_rows(df, ["k"]), "row_no", "k")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert got == list(enumerate(sorted(r.k for r in df.collect())))


def test_numbering_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    got = rows(ordering.number_rows(hot_table(spark), ["k"]), "row_no")
    assert [r[0] for r in got] == list(range(9000))


def test_stored_table_is_numbered_without_sorting_its_rows(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    numbered = ordering.number_stored_rows(spark, path)
    total = spark.read.parquet(path).count()
    assert [r[0] for r in rows(numbered, "row_no")] == list(range(total))
    # The only window runs over one row per file.
    plan = plan_of(numbered)
    assert plan.count("Window") <= 1 and "BroadcastHashJoin" in plan


def test_running_total(spark):
    df = hot_table(spark).withColumn("w", F.col("k") % 5)
    pairs = sorted((r.k, r.w) for r in df.collect())
    got = rows(ordering.running_total(df, ["k"], "w"), "running_total")
    assert [r[0] for r in got] == list(accumulate(w for _, w in pairs))


def test_empty_table(spark):
    assert ordering.number_rows(hot_table(spark).filter("k < 0"), ["k"]).count() == 0


@pytest.mark.parametrize("max_rows", [0, 200_000])
def test_running_total_of_blocks(spark, monkeypatch, max_rows):
    """Weights that are null at first, later, and for whole blocks; two files of several blocks."""
    monkeypatch.setattr(ordering, "BLOCK", 64)
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", max_rows)
    df = spark.range(0, 2000, 1, 2).selectExpr(
        "id as k", "if(id < 100 or id between 500 and 1300 or id % 7 = 0, null, id * 5 % 11 - 3) as w"
    )
    path = ordering.scratch_dir(spark, "blocks")
    df.write.parquet(path)
    expected, total = [], None
    for r in sorted(df.collect()):
        total = total if r.w is None else (total or 0) + r.w
        expected.append((r.k, total))
    assert rows(ordering.stored_running_total(spark, path, "w"), "k", "running_total") == expected


def test_running_total_deals_blocks_not_files(spark, monkeypatch):
    """However few and large the files are, no task holds more than some blocks."""
    monkeypatch.setattr(ordering, "BLOCK", 100)
    path = ordering.scratch_dir(spark, "one-file")
    spark.range(0, 40_000, 1, 1).selectExpr("id as k", "id % 5 as w").write.parquet(path)
    got = ordering.stored_running_total(spark, path, "w").withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in got.groupBy("task").count().collect()]
    assert len(sizes) > 30 and max(sizes) <= 4 * 100 * ordering.TASK_BLOCKS


def test_sort_has_as_many_tasks_as_the_rows_need(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORT_ROWS", 300)
    df = hot_table(spark).withColumn("w", F.col("k") % 5)
    written = []
    store = ordering.store_sorted
    monkeypatch.setattr(ordering, "store_sorted", lambda *a, **k: written.append(store(*a, **k)) or written[-1])
    got = rows(ordering.running_total(df, ["k"], "w"), "k", "running_total")
    assert [r[1] for r in got] == list(accumulate(k % 5 for k, _ in got))
    stored = spark.read.parquet(*written).groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(stored) > 20 and max(r["count"] for r in stored) < 900
