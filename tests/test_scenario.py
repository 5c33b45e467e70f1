from __future__ import annotations

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.queries import CONFIG, base_rows
from tests.conftest import plan_of, rows
from trilayer.config import UpliftRates
from trilayer.functions import hash_pick, hash_uniform
from trilayer.operators import ordering, scenario
from trilayer.plans.scenario import build_scenario, run_scenario
from trilayer.sinks import write_landing
from trilayer.sources import read_delimited

ALWAYS = UpliftRates((1.0, 1.0), (1.0, 1.0), (1.0, 1.0))
NEVER = UpliftRates((0.0, 0.0), (0.0, 0.0), (0.0, 0.0))
PARTS = ("fatal", "serious", "minor")


def apply(df, rates, **options):
    no = F.lit(False)
    return scenario.uplift(df, rates, 1, no, no, row_id="id", **options)


def test_draws_are_uniform_and_repeatable(spark):
    df = spark.range(20_000).select(
        hash_uniform(1, "a", F.col("id")).alias("u"), hash_pick(1, "a", F.col("id"), 10).alias("k")
    )
    got = df.collect()
    assert Counter(got) == Counter(df.repartition(5).collect())
    assert 0 <= min(r.u for r in got) and max(r.u for r in got) < 1
    assert sum(r.u for r in got) / len(got) == pytest.approx(0.5, abs=0.01)
    assert set(r.k for r in got) == set(range(10))
    assert all(abs(n - 2000) < 250 for n in Counter(r.k for r in got).values())


@pytest.mark.parametrize(
    ("growth", "size"), [(0.01, 1010), (0.05, 1050), (0.9, 1050), (-0.03, 970), (-0.9, 950), (0.0, 1000)]
)
def test_size_is_clamped(spark, growth, size):
    assert spark.range(1).select(scenario.scenario_size(F.lit(1000), F.lit(growth))).first()[0] == size


def test_bootstrap_draws_the_picked_rows(spark):
    base = spark.range(100).selectExpr("id * 10 as v")
    numbered = ordering.number_rows(base, ["v"])
    drawn = rows(scenario.bootstrap(numbered, 100, 250, 5), "draw_id", "v")
    picks = spark.range(250).select(hash_pick(5, "pick", F.col("id"), 100)).collect()
    assert drawn == [(i, r[0] * 10) for i, r in enumerate(picks)]


def test_bootstrap_of_a_hot_row_has_no_cross_join(spark):
    base = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) as v")
    numbered = ordering.number_rows(base, ["v"])
    drawn = scenario.bootstrap(numbered, 3000, 6000, 5)
    assert drawn.count() == 6000
    assert drawn.filter("v = 0").count() == pytest.approx(2000, abs=150)
    plan = plan_of(drawn)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_ids_keep_their_type(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "b", 2)], "draw_id int, key string, num bigint")
    assert rows(scenario.reassign_ids(df, "key", 100), "key") == [("100",), ("101",)]
    assert rows(scenario.reassign_ids(df, "num", 100), "num") == [(100,), (101,)]
    assert scenario.reassign_ids(df, "absent", 1) is df


def test_uplift_rewrites_only_rows_that_gain(spark):
    df = spark.createDataFrame(
        [(1, " 2,0", "1", "0", "0"), (2, None, None, "x", "3"), (3, "0", "-5", "0", "1")],
        "id int, casualties string, fatal string, serious string, minor string",
    )
    assert rows(apply(df, NEVER)) == rows(df)
    assert rows(apply(df, ALWAYS)) == [
        (1, "2", "1", "0", "1"),
        (2, "4", None, "x", "4"),
        (3, "0", "-5", "0", "2"),
    ]


def test_uplift_with_fewer_columns(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (3, -4)], "id int, casualties int")
    assert rows(apply(df, ALWAYS)) == [(1, 3), (2, 1), (3, 0)]
    with_minor = df.withColumn("minor", F.lit(7))
    assert rows(apply(with_minor, ALWAYS), "casualties", "minor") == [(0, 8), (1, 8), (3, 8)]
    assert apply(df.drop("casualties"), ALWAYS).columns == ["id"]


def test_uplift_rates_by_segment_and_day(spark):
    rates = CONFIG.rates
    df = spark.range(200_000).selectExpr(
        "id", "cast(id % 2 as int) as casualties", "(id div 2) % 2 = 1 as s", "(id div 4) % 2 = 1 as d"
    )
    up = scenario.uplift(df, rates, 1, F.col("s"), F.col("d"), row_id="id")
    shares = up.join(df.selectExpr("id", "casualties as before"), "id").groupBy("before", "s", "d").agg(
        F.avg(F.col("casualties") - F.col("before")).alias("share")
    )
    for r in shares.collect():
        pair = rates.segment_day if r.s and r.d else rates.segment_other if r.s else rates.rest
        assert r.share == pytest.approx(pair[r.before], abs=0.006)


def test_uplift_never_lowers(spark, sf_dir):
    base = base_rows(spark, sf_dir).withColumn("id", F.col("incident_id"))
    before = {r.id: int(r.casualties) for r in base.collect()}
    after = {r.id: int(r.casualties) for r in apply(base, ALWAYS).collect()}
    assert all(after[i] >= before[i] for i in before)


def test_sum_of_parts(spark):
    df = spark.createDataFrame([("1", "2", None, "9"), ("-5", "0", "1", "9")], "fatal string, serious string, minor string, casualties string")
    assert [r.casualties for r in scenario.sum_components(df, PARTS, "casualties").collect()] == [3, 0]
    assert scenario.sum_components(df.drop("minor"), PARTS, "casualties").columns == ["fatal", "serious", "casualties"]


def test_scenario_does_not_depend_on_partitioning(spark, sf_dir):
    base = base_rows(spark, sf_dir)
    made = build_scenario(base, CONFIG)
    again = build_scenario(base.repartition(13), CONFIG)
    assert rows(made.rows) == rows(again.rows)
    assert made.rows.columns == base.columns
    n = base.count()
    assert made.metadata["n_base"] == n
    assert made.metadata["n_generated"] == made.rows.count() == int(n * 1.01 + 0.5)
    ids = sorted(int(r.incident_id) for r in made.rows.select("incident_id").collect())
    top = max(int(r.incident_id) for r in base.select("incident_id").collect())
    assert ids == list(range(top + 1, top + 1 + len(ids)))
    assert rows(made.rows.select("yr").distinct()) == [("2000",)]


def test_scenario_of_a_bare_table(spark):
    base = spark.createDataFrame([("x",), ("y",)], "other string")
    made = build_scenario(base, replace(CONFIG, growth=0.0))
    assert made.rows.columns == ["other", "yr"] and made.rows.count() == 2
    with pytest.raises(ValueError, match="empty"):
        build_scenario(base.filter("other = 'z'"), CONFIG)


def test_day_codes_fall_back_to_the_most_frequent(spark):
    base = spark.createDataFrame([("1", "3,0"), ("2", "3"), ("3", "4")], "incident_id string, light string")
    assert build_scenario(base, replace(CONFIG, day_codes=())).metadata["day_codes"] == [3]


def test_job_replaces_the_landed_scenario(spark, sf_dir, tmp_path):
    base, out = str(tmp_path / "yr=1996"), str(tmp_path / "yr=2000")
    write_landing(base_rows(spark, sf_dir), base)
    for _ in range(2):
        made = run_scenario(spark, base, out, CONFIG)
    assert read_delimited(spark, out).count() == made.metadata["n_generated"]
    record = spark.read.json(f"{out}/_run_metadata").first()
    assert (record.source, record.output, record.seed) == (base, out, CONFIG.seed)
    assert record.target_weather == [6] and record.target_light == [4, 5]
