from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from checks.queries import gold
from tests.conftest import plan_of, rows
from trilayer.functions import safe_ratio
from trilayer.operators import distribution, joins, marts
from trilayer.operators.typing import restrict_to
from trilayer.plans.incidents import KPI_DIMS
from trilayer.plans.report import day_label, light_label, report_marts, segment_text


@pytest.fixture(scope="module")
def facts(spark, sf_dir):
    return gold(spark, sf_dir).cache()


def test_kpis_against_counting_by_hand(facts):
    count, total = Counter(), Counter()
    for r in facts.select(*KPI_DIMS, "casualties").collect():
        count[r[:4]] += 1
        total[r[:4]] += r[4]
    got = {r[:4]: tuple(r[4:]) for r in map(tuple, marts.kpi_mart(facts, KPI_DIMS, "casualties").collect())}
    assert got == {k: (n, total[k], total[k] / n) for k, n in count.items()}


def test_kpis_leave_out_what_is_absent(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 2)], "yr int, x int")
    assert rows(marts.kpi_mart(df, ["yr", "absent"], "absent")) == [(2024, 2)]
    assert rows(marts.kpi_mart(df, [], "x")) == [(2, 3, 1.5)]


def test_two_means(spark):
    df = spark.createDataFrame([(2024, 2), (2024, None), (None, 9)], "yr int, casualties int")
    assert rows(marts.kpi_mart(df, ["yr"], "casualties")) == [(None, 1, 9, 9.0), (2024, 2, 2, 2.0)]
    assert rows(marts.by_year(df)) == [(2024, 2, 2.0, 1.0)]
    assert rows(marts.by_year(df.drop("casualties"))) == [(2024, 2, 0.0, 0.0)]


def test_report_from_kpis_equals_report_from_rows(facts):
    years = (1996, 2000)
    two = restrict_to(facts, "yr", years)
    report = report_marts(marts.kpi_mart(facts, KPI_DIMS, "casualties"), *years)
    direct = {
        "by_year": marts.by_year(two),
        "by_year_day": marts.by_year_and(two, day_label(), "day_label"),
        "by_year_light": marts.by_year_and(two, light_label(), "light_label"),
        "by_year_segment": marts.by_year_and(two, segment_text(), "segment_label"),
    }
    for name, mart in direct.items():
        assert rows(report[name]) == rows(mart), name
    assert rows(report["comparison"]) == rows(
        marts.compare(marts.by_year(two), *years, (marts.ROWS, marts.TOTAL, marts.MEAN))
    )
    assert {r.metric for r in report["by_year_long"].collect()} == {marts.ROWS, marts.TOTAL, marts.MEAN}
    assert {r.day_label for r in report["comparison_by_day"].collect()} <= {"Día", "No día"}


def test_compare_with_a_missing_year(spark):
    mart = spark.createDataFrame([(2024, 10, 2.5)], "yr int, a int, b double")
    assert rows(marts.compare(mart, 2024, 2026, ["a", "b"])) == [("a", 10.0, None, None), ("b", 2.5, None, None)]
    assert rows(marts.compare(mart, 2023, 2024, ["a"])) == [("a", None, 10.0, None)]


def test_to_long(spark):
    mart = spark.createDataFrame([(2024, 10, 2.5)], "yr int, a int, b double")
    assert rows(marts.to_long(mart, ["yr"], ["a", "b"])) == [(2024, "a", 10.0), (2024, "b", 2.5)]


def test_mode_and_max_key(spark):
    df = spark.createDataFrame([("3",), ("3",), ("10",), ("10",), (None,), (None,), (None,), ("x",)], "v string")
    assert rows(marts.mode_of(df.selectExpr("try_cast(v as int) v"), "v")) == [(3, 2)]
    assert marts.mode_of(df.filter("v is null"), "v").count() == 0
    assert marts.max_key(df, "v").first()[0] == 10
    assert marts.max_key(df.filter("v = 'x'"), "v").first()[0] == 0


def test_ratio_by_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (0, 0)], "a int, b int")
    assert rows(df.select(safe_ratio(F.col("a"), F.col("b")))) == [(None,), (None,), (0.5,)]


def test_what_if(spark):
    df = spark.createDataFrame([(True, 10), (False, 10), (None, 10)], "s boolean, c int")
    assert rows(marts.reduction_what_if(df, "s", "c", 0.7), "reduced") == [(7.0,), (10.0,), (10.0,)]


def by_hand(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
    return low + (high - low) * (at - int(at))


@pytest.mark.parametrize("bound", [joins.BROADCAST_MAX_ROWS, 0])
@pytest.mark.parametrize("find", [distribution.percentiles, distribution.percentiles_by_rank])
def test_percentiles_with_a_hot_group_and_a_hot_value(spark, monkeypatch, find, bound):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", bound)
    points = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    df = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 2024, if(id % 7 = 1, null, 2000 + cast(id % 7 as int))) as yr",
        "if(id % 2 = 0, 5.0D, if(id % 11 = 0, null, cast(id * 7919 % 1009 as double) / 4)) as v",
    )
    groups = defaultdict(list)
    for r in df.collect():
        if r.v is not None:
            groups[r.yr].append(r.v)
    got = {r.yr: tuple(r)[1:] for r in find(df, ["yr"], "v", points).collect()}
    want = {yr: tuple(by_hand(v, p) for p in points.values()) for yr, v in groups.items()}
    assert got.keys() == want.keys()
    for yr in want:
        assert got[yr] == pytest.approx(want[yr], rel=1e-12)


def test_percentiles_of_the_whole_table(spark):
    df = spark.range(101).selectExpr("cast(id as double) as v")
    for find in (distribution.percentiles, distribution.percentiles_by_rank):
        assert rows(find(df, [], "v", {"p50": 0.5, "p99": 0.99})) == [(50.0, 99.0)]


def test_distribution_and_zero_share(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 3), (1, None)], "yr int, v int")
    assert rows(distribution.value_distribution(df, ["yr"], "v")) == [(1, None, 1), (1, 0, 2), (1, 3, 1)]
    assert rows(distribution.zero_share(df, ["yr"], "v")) == [(1, 0.5)]


def test_aggregates_combine_before_the_shuffle(facts):
    plan = plan_of(marts.kpi_mart(facts, KPI_DIMS, "casualties"))
    assert "partial_sum" in plan and plan.count("Exchange") == 1


def test_percentiles_by_rank_sort_only_the_brackets(spark):
    """A group with many more rows than the sketch's accuracy, half of them one value, and NaN."""
    points = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    df = spark.range(300_000).selectExpr(
        "'g' as yr", "if(id % 2 = 0, 50000.0D, if(id % 1001 = 3, double('NaN'), cast(id * 7919 % 100003 as double) / 3)) as v"
    )
    values = sorted(r.v for r in df.filter("not isnan(v)").collect())
    (got,) = distribution.percentiles_by_rank(df, ["yr"], "v", points).collect()
    assert tuple(got)[1:] == pytest.approx([by_hand(values, p) for p in points.values()], rel=1e-12)
