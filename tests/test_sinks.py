from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer import publish
from trilayer.sinks import (
    SplitTotals,
    replace_partition,
    scratch_dir,
    split_write,
    write_landing,
    write_run_metadata,
    write_table,
)
from trilayer.sinks import tables
from trilayer.sources import read_delimited, read_partitioned, read_side


def files(path: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for file in Path(path).rglob("*.parquet"):
        found[file.parent.name] = found.get(file.parent.name, 0) + 1
    return found


def test_text_round_trip_keeps_spaces_quotes_and_nulls(spark, tmp_path):
    values = [("1", " 3,0 "), ("2", 'say "hi"; now'), ("3", None), ("4", "é")]
    df = spark.createDataFrame(values, "id string, t string")
    write_landing(df, str(tmp_path / "l"))
    assert rows(read_delimited(spark, str(tmp_path / "l")), "id", "t") == sorted(values)


def test_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "cast(id % 2 as int) as yr")
    write_table(df.repartition(6), path, "yr")
    assert files(path) == {"yr=0": 6, "yr=1": 6}
    write_table(df.repartition(6), path, "yr", cluster=True)
    assert files(path) == {"yr=0": 1, "yr=1": 1}
    assert rows(read_partitioned(spark, path), "id", "yr") == rows(df)
    write_table(df, path, "absent")
    assert "yr" in read_partitioned(spark, path).columns
    scan = read_partitioned(spark, path)
    assert scan.count() == 1000


def test_a_hot_partition_value_is_split(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200_000).selectExpr("id", "hash(id) as x", "if(id % 10 = 0, 1, 2) as yr")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    try:
        write_table(df.repartition(8), path, "yr", cluster=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert files(path)["yr=2"] > 4
    assert read_partitioned(spark, path).count() == 200_000


def test_file_size_cap(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(100).coalesce(1), path, max_records_per_file=30)
    assert sum(files(path).values()) == 4


@pytest.mark.parametrize("cluster", [False, True])
def test_replacing_a_partition_leaves_the_others(spark, tmp_path, cluster):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, 2024), (2, 2026)], "id int, yr int"), path, "yr")
    for _ in range(2):
        replace_partition(
            spark.createDataFrame([(9, 2026)], "id int, yr int"), path, "yr", cluster=cluster
        )
    assert rows(read_partitioned(spark, path)) == [(1, 2024), (9, 2026)]


@pytest.mark.parametrize("cluster", [False, True])
def test_replacing_one_named_partition_also_empties_it(spark, tmp_path, cluster):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 2024), (2, 2026)], "id int, yr int")
    write_table(old, path, "yr")
    new = spark.createDataFrame([(9, 2026)], "id int, yr int")
    for _ in range(2):
        replace_partition(new, path, "yr", 2026, cluster)
    for foreign in ("2024", "null"):
        mixed = new.union(spark.sql(f"select 8, int({foreign})"))
        with pytest.raises(ValueError, match="other partitions"):
            replace_partition(mixed, path, "yr", 2026, cluster)
    assert rows(read_partitioned(spark, path)) == [(1, 2024), (9, 2026)]
    replace_partition(new.filter("id = 0"), path, "yr", 2026, cluster)
    assert rows(read_partitioned(spark, path)) == [(1, 2024)]


SCHEMA = "id int, yr int, dq_valid boolean"


def test_split_write(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, 2024, True), (2, 2026, False), (3, None, False)], SCHEMA)
    assert split_write(df, path) == SplitTotals(3, 1, 2)
    assert rows(read_side(spark, path, "valid")) == [(1, 2024)]
    assert rows(read_side(spark, path, "quarantine")) == [(2, 2026), (3, None)]
    assert sorted(os.listdir(f"{path}/side=quarantine")) == ["yr=2026", "yr=__HIVE_DEFAULT_PARTITION__"]
    # A rerun replaces both sides.
    assert split_write(df.filter("id = 1"), path) == SplitTotals(1, 1, 0)
    assert rows(read_side(spark, path, "quarantine")) == []


def test_split_write_without_valid_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, 2024, False), (2, 2026, False)], SCHEMA)
    path = str(tmp_path / "both")
    assert split_write(df, path) == SplitTotals(2, 0, 2)
    for side in ("valid", "quarantine"):
        assert rows(read_side(spark, path, side)) == [(1, 2024), (2, 2026)]
    path = str(tmp_path / "one")
    split_write(df, path, on_zero_valid="quarantine")
    assert rows(read_side(spark, path, "valid")) == []
    with pytest.raises(ValueError, match="policy"):
        split_write(df, path, on_zero_valid="neither")


def test_split_write_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert split_write(empty, str(tmp_path / "s")) == SplitTotals(0, 0, 0)


def test_empty_partitioned_table_needs_a_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([], "id int, yr int")
    write_table(df, path, "yr")
    assert read_partitioned(spark, path, df.schema).count() == 0


def test_run_metadata(spark, tmp_path):
    path = str(tmp_path / "m")
    write_run_metadata(spark, {"seed": 7, "growth": 0.01, "day_codes": [1], "target_zone": ["1"]}, path)
    record = spark.read.json(path).first()
    assert (record.seed, record.growth, record.day_codes, record.target_zone) == (7, 0.01, [1], ["1"])


def test_scratch_is_new_for_each_use(spark):
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert root is None or one.startswith(root.rstrip("/") + "/")


class Killed(Exception):
    pass


def killed_after(monkeypatch, moves: int) -> None:
    """Let the job die when it has moved so many folders."""
    real, done = publish._move, []

    def move(*args):
        if len(done) == moves:
            raise Killed
        done.append(args)
        real(*args)

    monkeypatch.setattr(publish, "_move", move)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="broken"):
        write_table(spark.range(9).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    assert read_partitioned(spark, path).count() == 5
    assert os.listdir(tmp_path) == ["t"]


def test_a_job_killed_while_publishing_leaves_the_new_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    killed_after(monkeypatch, 0)
    with pytest.raises(Killed):
        write_table(spark.range(9), path)
    monkeypatch.undo()
    assert read_partitioned(spark, path).count() == 9
    assert os.listdir(tmp_path) == ["t"]


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_partitions_are_replaced_all_or_none(spark, tmp_path, monkeypatch, moves):
    path = str(tmp_path / "t")
    old = spark.range(30).selectExpr("id", "cast(id % 3 as int) as yr")
    write_table(old, path, "yr")
    killed_after(monkeypatch, moves)
    newer = old.filter("yr < 2").withColumn("id", F.col("id") + 100)
    if moves < 2:
        with pytest.raises(Killed):
            replace_partition(newer, path, "yr")
    else:
        replace_partition(newer, path, "yr")
    monkeypatch.undo()
    assert rows(read_partitioned(spark, path), "id", "yr") == rows(newer.union(old.filter("yr = 2")), "id", "yr")


def test_one_named_partition_is_settled_too(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(6).selectExpr("id", "cast(id % 2 as int) as yr"), path, "yr")
    killed_after(monkeypatch, 0)
    with pytest.raises(Killed):
        replace_partition(spark.createDataFrame([(77, 1)], "id long, yr int"), path, "yr", value=1)
    monkeypatch.undo()
    assert rows(read_partitioned(spark, path), "id", "yr") == [(0, 0), (2, 0), (4, 0), (77, 1)]


def test_the_policy_is_whole_or_not_there(spark, tmp_path, monkeypatch):
    """Killed between the write of one side and that of both, and in the midst of the moves."""
    path = str(tmp_path / "t")
    bad = spark.range(20).selectExpr("id", "cast(id % 2 as int) as yr", "false as dq_valid")
    split_write(spark.range(3).selectExpr("id", "1 as yr", "true as dq_valid"), path)
    before, real = rows(read_partitioned(spark, path)), tables.write_table

    def dies(df, *args, **kwargs):
        if "both" in args[0]:
            raise Killed
        real(df, *args, **kwargs)

    monkeypatch.setattr(tables, "write_table", dies)
    with pytest.raises(Killed):
        split_write(bad, path)
    monkeypatch.undo()
    assert rows(read_partitioned(spark, path)) == before
    for moves in range(4):
        killed_after(monkeypatch, moves)
        try:
            split_write(bad, path)
        except Killed:
            pass
        monkeypatch.undo()
        got = read_partitioned(spark, path).groupBy("side").count().collect()
        assert {r.side: r["count"] for r in got} in ({"valid": 20, "quarantine": 20}, {"valid": 3})
    assert {r.side for r in got} == {"valid", "quarantine"}
