from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.queries import base_rows
from tests.conftest import plan_of, rows
from trilayer.config import SourceSpec
from trilayer.operators.quality import FAULT_ARRAYS
from trilayer.operators.typing import restrict_to
from trilayer.plans.pipeline import Layout, land_base, run_all
from trilayer.plans.silver import run_silver
from trilayer.sinks import write_landing
from trilayer.sources import read_partitioned, read_side


@pytest.fixture(scope="module")
def installed(spark, sf_dir, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("pipeline")), 1996, 2000)
    land_base(base_rows(spark, sf_dir).withColumnRenamed("km", " km "), layout)
    return layout, run_all(spark, layout)


def test_every_row_is_on_exactly_one_side(spark, installed):
    layout, totals = installed
    valid, bad = (read_side(spark, layout.silver, s) for s in ("valid", "quarantine"))
    assert totals.total == totals.good + totals.bad
    assert (valid.count(), bad.count()) == (totals.good, totals.bad)
    assert totals.good > 0 and totals.bad > 0
    key = ["incident_id", "yr"]
    assert valid.select(key).intersect(bad.select(key)).count() == 0
    faults = F.lit(0)
    for c in FAULT_ARRAYS:
        faults = faults + F.size(c)
    assert valid.filter(faults > 0).count() == 0 and bad.filter(faults == 0).count() == 0


def test_gold_has_the_published_columns(spark, installed):
    gold = read_partitioned(spark, installed[0].gold)
    want = {"weather_desc", "light_desc", "incident_type_desc", "strategic", "pipe_warnings", "source_file", "ingest_ts", "scenario", *FAULT_ARRAYS}
    assert want <= set(gold.columns)
    assert gold.count() == installed[1].good
    assert gold.select("ingest_ts").distinct().count() == 1
    assert rows(gold.select("yr", "scenario").distinct()) == [(1996, "base"), (2000, "scenario")]


def test_kpis_add_up_to_gold(spark, installed):
    gold, kpis = (read_partitioned(spark, p) for p in (installed[0].gold, installed[0].kpis))
    sums = kpis.agg(F.sum("incidents"), F.sum("casualties_total")).first()
    assert tuple(sums) == tuple(gold.agg(F.count(F.lit(1)), F.sum("casualties")).first())


def test_report_tables(spark, installed):
    root = installed[0].report
    yearly = spark.read.parquet(f"{root}/by_year")
    assert {r.yr for r in yearly.collect()} == {1996, 2000}
    delta = {r.metric: r.delta for r in spark.read.parquet(f"{root}/comparison").collect()}
    by = {r.yr: r for r in yearly.collect()}
    assert delta["incidents"] == by[2000].incidents - by[1996].incidents
    for name in ("by_year_day", "by_year_light", "by_year_segment"):
        mart = spark.read.parquet(f"{root}/{name}")
        assert mart.agg(F.sum("incidents")).first()[0] == installed[1].good


def test_a_rerun_gives_the_same_tables(spark, installed):
    layout, totals = installed
    before = rows(read_partitioned(spark, layout.kpis))
    assert run_all(spark, layout) == totals
    assert rows(read_partitioned(spark, layout.kpis)) == before


def test_year_filter_prunes_folders_and_columns(spark, installed):
    scan = restrict_to(read_partitioned(spark, installed[0].gold), "yr", [1996]).select("casualties")
    plan = plan_of(scan)
    assert "PartitionFilters: [isnotnull(yr" in plan or "PartitionFilters: [yr" in plan
    assert "ReadSchema: struct<casualties:int>" in plan
    side = plan_of(read_side(spark, installed[0].silver, "valid"))
    assert "PartitionFilters: [isnotnull(side" in side


def test_base_year_alone(spark, sf_dir, tmp_path):
    layout = Layout(str(tmp_path), 1996, 2000)
    land_base(base_rows(spark, sf_dir), layout)
    run_all(spark, layout, with_scenario=False)
    sides = {r.metric: (r.scenario_value, r.delta) for r in spark.read.parquet(f"{layout.report}/comparison").collect()}
    assert sides["incidents"] == (None, None)


def test_empty_landing_fails(spark, tmp_path):
    write_landing(spark.createDataFrame([], "yr string, casualties string"), str(tmp_path / "l"))
    with pytest.raises(ValueError, match="empty"):
        run_silver(spark, [SourceSpec((str(tmp_path / "l"),))], str(tmp_path / "s"))
