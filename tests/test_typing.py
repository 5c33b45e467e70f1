from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer.functions import normalize_number, parse_bool, safe_double, safe_int, zero_fill
from trilayer.operators import typing as ty

NUMBERS = [
    ("7,319", 7.319, 7),
    (" 7,319 ", 7.319, 7),
    ("1,234,5", None, None),
    ("abc", None, None),
    ("", None, None),
    ("null", None, None),
    (None, None, None),
    ("1e3", 1000.0, 1000),
    ("2.5", 2.5, 3),
    ("-2.5", -2.5, -3),
    ("-0.5", -0.5, -1),
    ("99999999999", 99999999999.0, None),
    ("nan", None, None),
    ("inf", None, None),
    ("-Infinity", None, None),
    ("\t5", 5.0, 5),
    (" 5", None, None),
]


@pytest.mark.parametrize("ansi", [True, False])
def test_messy_numbers(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(NUMBERS)], "i int, t string")
        got = texts.select("i", safe_double(F.col("t")).alias("d"), safe_int(F.col("t")).alias("n"))
        assert {r.i: (r.d, r.n) for r in got.collect()} == {
            i: (d, n) for i, (_, d, n) in enumerate(NUMBERS)
        }
    finally:
        spark.conf.set("spark.sql.ansi.enabled", True)


def test_normalize_and_zero_fill(spark):
    df = spark.createDataFrame([(" 1,5 ",), ("x",), (None,)], "t string")
    assert rows(df.select(normalize_number(F.col("t")))) == [(None,), ("1.5",), ("x",)]
    assert rows(df.select(zero_fill(F.col("t")))) == [(0.0,), (0.0,), (1.5,)]


def test_large_ids_keep_their_value(spark):
    df = spark.createDataFrame([("99999999999",)], "id string")
    assert ty.apply_types(df, {"id": "bigint"}).first().id == 99_999_999_999


def test_apply_types_leaves_other_columns(spark):
    df = spark.createDataFrame([("1,6", "x ", "z")], "a string, other string, d string")
    typed = ty.apply_types(df, {"a": "int", "absent": "int", "d": "double"}, unparsed="bad")
    assert typed.columns == ["a", "other", "d", "bad"]
    assert tuple(typed.first()) == (2, "x ", None, ["d"])


def test_blank_text_is_not_an_unparsed_value(spark):
    df = spark.createDataFrame([("",), (None,), ("7",)], "a string")
    assert [r.bad for r in ty.apply_types(df, {"a": "int"}, unparsed="bad").collect()] == [[], [], []]


def test_parse_bool(spark):
    words = [("TRUE", True), (" sí ", True), ("Si", True), ("1", True), ("y", True), ("no", False), ("", False), (None, False), ("2", False)]
    df = spark.createDataFrame(words, "t string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", parse_bool(F.col("t"))).collect())
    flags = spark.createDataFrame([(True,), (None,), (False,)], "f boolean")
    assert [r[0] for r in flags.select(parse_bool(F.col("f"))).collect()] == [True, False, False]


def test_required_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert ty.require_columns(df, ["a"]) is df
    with pytest.raises(ty.MissingColumnsError, match="'b', 'c'"):
        ty.require_columns(df, ["a", "b", "c"])


def test_require_non_empty(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert ty.require_non_empty(df, "x") is df
    with pytest.raises(ValueError, match="nothing here"):
        ty.require_non_empty(df.filter("a > 1"), "nothing here")


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], [" a ", "b\t"])
    assert ty.normalize_headers(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="repeat"):
        ty.normalize_headers(spark.createDataFrame([(1, 2)], ["a", " A "]))


def test_small_projections(spark):
    df = spark.createDataFrame([("1", "2,0"), ("2", None)], "yr string, light string")
    assert [tuple(r) for r in ty.with_year(df, 2030).collect()] == [("2030", "2,0"), ("2030", None)]
    assert ty.with_year(df.drop("yr"), 2030).columns == ["light", "yr"]
    assert rows(ty.restrict_to(df, "yr", ["1", "9"]), "yr") == [("1",)]
    assert dict(ty.placeholder(df, "flag", "boolean").dtypes)["flag"] == "boolean"
    assert ty.placeholder(df, "yr", "boolean") is df
    labelled = ty.fallback_label(df, "light", "light_desc", "unknown")
    assert rows(labelled, "light_desc") == [("2",), ("unknown",)]
    assert ty.fallback_label(labelled, "light", "light_desc", "?") is labelled
    assert ty.fallback_label(df, "absent", "x", "?") is df
