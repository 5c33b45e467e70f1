from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer.config import Contract, SourceSpec
from trilayer.operators.quality import dq
from trilayer.sources import read_delimited, read_sources


@pytest.fixture()
def landing(tmp_path):
    def put(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path.parent)

    return put


def test_corrupt_lines_are_kept_and_flagged(spark, landing):
    path = landing("a/x.csv", "ID; ANYO ;M\n1;2024;3\n2;2024\n3;2024;4;EXTRA\n")
    df = read_delimited(spark, path)
    assert df.columns == ["ID", "ANYO", "M", "_corrupt_record", "source_file", "ingest_ts"]
    assert rows(df, "ID", "M", "_corrupt_record") == [("1", "3", None), ("2", None, "2;2024"), ("3", "4", "3;2024;4;EXTRA")]
    checked = dq(df, Contract(types={}))
    assert rows(checked.filter(~F.col("dq_valid")), "ID") == [("2",), ("3",)]
    # A query over few columns still sees the corrupt lines.
    few = checked.agg(F.count_if(F.size("dq_corrupt") > 0).alias("n"), F.max("ID").alias("last"))
    assert tuple(few.first()) == (2, "3")


def test_only_csv_files_at_any_depth(spark, landing):
    path = landing("a/x.csv", "ID;V\n1;a\n")
    landing("a/deep/yr=2026/y.csv", "ID;V\n2;b\n")
    landing("a/z.txt", "ID;V\n3;c\n")
    df = read_delimited(spark, path)
    assert rows(df, "ID", "V") == [("1", "a"), ("2", "b")]
    assert "yr" not in df.columns


def test_files_with_another_header_fail_instead_of_being_misread(spark, landing):
    path = landing("a/x.csv", "ID;ANYO;M\n1;2024;3\n")
    landing("a/y.csv", "ID;M;ANYO\n2;4;2025\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_delimited(spark, path).collect()


def test_sources_with_other_layouts_bind_by_name(spark, landing):
    one = landing("a/x.csv", "ID;ANYO;M\n1;2024;3\n")
    two = landing("b/x.csv", "ID;M;ANYO;NEW\n2;4;2026;n\n")
    df = read_sources(
        spark,
        [
            SourceSpec((f"{one}/none.csv", one), label="base"),
            SourceSpec((two,), required=False, label="scenario"),
        ],
    )
    assert rows(df, "ID", "ANYO", "M", "NEW", "scenario") == [
        ("1", "2024", "3", None, "base"),
        ("2", "2026", "4", "n", "scenario"),
    ]


def test_first_path_that_exists_wins(spark, landing):
    path = landing("a/x.csv", "ID\n1\n")
    landing("a/y.csv", "ID\n2\n")
    assert rows(read_sources(spark, [SourceSpec((f"{path}/x.csv", path))]), "ID") == [("1",)]


def test_optional_sources_may_be_missing_or_empty(spark, landing, tmp_path):
    path = landing("a/x.csv", "ID\n1\n")
    (tmp_path / "hollow").mkdir()
    specs = [
        SourceSpec((path,)),
        SourceSpec((str(tmp_path / "absent"),), required=False),
        SourceSpec((str(tmp_path / "hollow"),), required=False),
    ]
    assert read_sources(spark, specs).count() == 1
    with pytest.raises(FileNotFoundError, match="absent"):
        read_sources(spark, [SourceSpec((str(tmp_path / "absent"),))])
    with pytest.raises(FileNotFoundError):
        read_sources(spark, specs[1:])


def test_lineage_is_one_time_for_the_run(spark, landing):
    one, two = landing("a/x.csv", "ID\n1\n"), landing("b/x.csv", "ID\n2\n")
    stamp = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    df = read_sources(spark, [SourceSpec((one,)), SourceSpec((two,))], run_ts=stamp)
    assert {r[0] for r in df.select(F.unix_timestamp("ingest_ts")).collect()} == {int(stamp.timestamp())}
    assert {r.source_file.split("/")[-2] for r in df.collect()} == {"a", "b"}


def test_known_columns_need_no_header_job(spark, landing):
    path = landing("a/x.csv", "ID;V\n1;a\n")
    assert rows(read_delimited(spark, path, columns=["ID", "V"]), "ID", "V") == [("1", "a")]
