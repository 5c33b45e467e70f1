from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from trilayer import fixed_values as fixed
from trilayer.config import SegmentRule
from trilayer.functions import safe_int
from trilayer.operators import enrich, joins
from trilayer.operators.typing import MissingColumnsError
from trilayer.plans.incidents import DAY_CODES, SEGMENT_RULE


def test_literal_lookup(spark):
    df = spark.createDataFrame([(1,), (7,), (None,)], "code int")
    mapping = {"1": "one", "2": "two"}
    assert rows(enrich.lookup(df, mapping, "code", "label")) == [(None, None), (1, "one"), (7, None)]
    assert rows(enrich.lookup(df, mapping, "code", "label", "?"), "label") == [("?",), ("?",), ("one",)]
    assert enrich.lookup(df, {}, "code", "label") is df
    assert enrich.lookup(df, mapping, "absent", "label") is df


@pytest.mark.parametrize("bound", [joins.BROADCAST_MAX_ROWS, 1])
def test_table_lookup_keeps_rows_on_both_sides_of_the_bound(spark, monkeypatch, bound):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", bound)
    facts = spark.range(3000).selectExpr("if(id % 3 = 0, 7, cast(id % 5 as int)) as code", "id")
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (1, "uno"), (7, "seven"), (None, "none")], "c int, l string")
    out = enrich.lookup_table(facts, dim, "code", "label", "c", "l", default="?")
    assert out.count() == 3000
    names = {0: "zero", 1: "one", 7: "seven"}
    assert all(r.label == names.get(r.code, "?") for r in out.collect())


def test_only_a_measured_dictionary_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        facts = spark.range(100)
        small = spark.range(10).withColumn("x", F.lit("a"))
        large = spark.range(11).withColumn("x", F.lit("a"))
        assert "BroadcastHashJoin" in plan_of(joins.join_dimension(facts, small, "id"))
        assert "Broadcast" not in plan_of(joins.join_dimension(facts, large, "id"))
        assert not joins.fits_broadcast(small, max_rows=10, max_bytes=20)
        assert joins.fits_broadcast(small.filter("id < 0"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_codes_by_keyword(spark):
    dim = spark.createDataFrame(list(fixed.LIGHT_LABELS.items()), "code string, label string")
    assert rows(enrich.codes_matching(dim, "code", "label", fixed.DAY_KEYWORDS)) == [("1",)]
    assert rows(enrich.codes_matching(dim, "code", "label", [])) == []
    assert DAY_CODES == (1,)
    assert enrich.matching_codes({"x": "día", "2": "DÍA", "3": "noche"}, fixed.DAY_KEYWORDS) == (2,)


def rule(zones, weathers, lights):
    return SegmentRule(("zone", zones), (("weather", weathers), ("light", lights)))


@pytest.mark.parametrize("zones", [(), ("1",)])
@pytest.mark.parametrize("weathers", [(), (6,)])
@pytest.mark.parametrize("lights", [(), (4, 5)])
def test_segment_truth_table(spark, zones, weathers, lights):
    points = list(product([None, 1, 2], [None, 6, 1], [None, 4, 1]))
    df = spark.createDataFrame(points, "zone int, weather int, light int")

    def expected(zone, weather, light):
        if not zones and not weathers and not lights:
            return False
        gate = True if not zones else (None if zone is None else str(zone) in zones)
        hits = [
            False if not allowed else (None if value is None else value in allowed)
            for value, allowed in ((weather, weathers), (light, lights))
        ]
        either = True if True in hits else (None if None in hits else False)
        return gate is True and either is True

    got = enrich.segment(df, rule(zones, weathers, lights), "s").collect()
    assert all(r.s == expected(r.zone, r.weather, r.light) for r in got)


def test_segment_columns(spark):
    df = spark.createDataFrame([(" 1,0 ", "6", "x")], "zone string, weather string, light string")
    with pytest.raises(MissingColumnsError):
        enrich.segment(df.drop("light"), SEGMENT_RULE)
    typed = enrich.segment_column(SEGMENT_RULE, lambda c: safe_int(F.col(c)))
    assert df.select(typed).first()[0] is True
    open_gate = enrich.segment_present(SEGMENT_RULE, ["weather", "light"])
    assert open_gate.gate[1] == () and open_gate.any_of == SEGMENT_RULE.any_of
    assert enrich.segment_present(SEGMENT_RULE, ["zone"]).any_of == (("weather", ()), ("light", ()))


def test_day_and_labels(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "light int")
    assert rows(enrich.day_flag(df, [1]), "is_day") == [(False,), (False,), (True,)]
    assert rows(enrich.day_flag(df, []), "is_day") == [(False,)] * 3
    labelled = enrich.segment_label(df.selectExpr("light = 1 as f"), "f", "yes", "no")
    assert rows(labelled, "segment_label") == [("no",), ("no",), ("yes",)]


@pytest.mark.parametrize("hot", ["7", "null"])
@pytest.mark.parametrize("spread_by", [(), ("id",)])
def test_a_hot_code_is_dealt_out_beyond_the_bound(spark, monkeypatch, hot, spread_by):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 60_000, 1, 8).selectExpr(
            "id", "hash(id) as x", f"if(id % 2 = 0, {hot}, cast(id % 5000 as int)) as code"
        )
        dim = spark.range(5000).selectExpr("id as c", "concat('label ', id) as l")
        out = enrich.lookup_table(facts, dim, "code", "label", "c", "l", spread_by=spread_by)
        assert "_salt" not in out.columns
        # Only the list of heavy codes is broadcast, to each side.
        assert plan_of(out).count("BroadcastHashJoin") == 2 and "SortMergeJoin" in plan_of(out)
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 60_000 and max(per_task) < 60_000 / 4
        labelled = out.filter("label = concat('label ', code)").count()
        assert labelled == (60_000 if hot == "7" else 30_000)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_copies_of_a_hot_row_are_split_by_adaptive_execution(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 60_000, 1, 8).selectExpr(
            "if(id % 2 = 0, 1, id) as x", "if(id % 2 = 0, 7, cast(id % 5000 as int)) as code"
        )
        dim = spark.range(5000).selectExpr("id as c", "concat('label ', id) as l")
        out = enrich.lookup_table(facts, dim, "code", "label", "c", "l")
        executed = out.selectExpr("count(*)", "count(label)", "sum(x)")
        assert tuple(executed.collect()[0])[:2] == (60_000, 60_000)
        assert "skew=true" in plan_of(executed)
    finally:
        for key in settings:
            spark.conf.unset(key)
