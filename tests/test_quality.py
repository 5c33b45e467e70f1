from __future__ import annotations

import contextlib
import io
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trilayer.config import Contract
from trilayer.operators import quality as q
from trilayer.operators.enrich import segment
from trilayer.operators.typing import MissingColumnsError, apply_types, invalid_rows, valid_rows
from trilayer.plans.incidents import CONTRACT, SEGMENT_RULE, TYPES
from trilayer.sinks import write_landing
from trilayer.sources import read_delimited

# case, weather, light, zone, casualties, hr, strategic, missing, domain, range
CASES = [
    ("fog, interurban", "6", "1", "1", "0", "1", True, "", "", ""),
    ("dark, interurban", "1", "5", "1", "2", "1", True, "", "", ""),
    ("dark, other zone", "1", "5", "2", "2", "1", False, "", "", ""),
    ("null weather, dark", None, "4", "1", "1", "1", True, "weather", "", ""),
    ("null weather, day", None, "1", "1", "1", "1", False, "weather", "", ""),
    ("null zone", "6", "4", None, "1", "1", False, "zone", "", ""),
    ("unknown code", "0", "1", "1", "1", "1", False, "", "weather", ""),
    ("two faults", "10", "6", "1", "-1", "1", False, "", "weather,light", "casualties"),
    ("bad optional text", "1", "1", "1", "1", "abc", False, "", "", ""),
    ("hour out of range", "1", "1", "1", "1", "24", False, "", "", "hr"),
    ("unparsable required", "1", "1", "1", "x", "1", False, "casualties", "", ""),
]


@pytest.fixture()
def cases(spark):
    raw = spark.createDataFrame(
        [(c[0], "2024", *c[1:6]) for c in CASES],
        "name string, yr string, weather string, light string, zone string, casualties string, hr string",
    )
    return apply_types(raw, TYPES)


def test_rule_rows(cases):
    checked = segment(q.dq(cases, CONTRACT), SEGMENT_RULE)
    got = {
        r.name: (r.strategic, ",".join(r.dq_missing), ",".join(r.dq_domain), ",".join(r.dq_range), r.dq_corrupt, r.dq_valid)
        for r in checked.collect()
    }
    assert got == {c[0]: (*c[6:], [], not any(c[7:])) for c in CASES}


def test_totals_and_sides_agree(cases):
    checked = q.dq(cases, CONTRACT)
    totals = q.dq_totals(checked).first()
    assert tuple(totals) == (len(CASES), 4, 7)
    assert valid_rows(checked).count() == totals.good
    assert invalid_rows(checked).count() == totals.bad
    assert "dq_valid" not in valid_rows(checked).columns


def test_two_checked_frames_can_be_combined(cases):
    both = valid_rows(q.dq(cases, CONTRACT)).unionByName(invalid_rows(q.dq(cases, CONTRACT)))
    assert both.count() == len(CASES)


def test_a_filter_on_the_verdict_does_not_repeat_the_typing(cases):
    plan = plan_of(valid_rows(q.dq(cases, CONTRACT)))
    (condition,) = [line for line in plan.splitlines() if "Filter" in line]
    assert "try_cast" not in condition


def test_generated_methods_stay_small_enough_for_the_jvm(spark, tmp_path):
    path = str(tmp_path / "wide")
    write_landing(spark.range(5).select(*[F.lit("1").alias(c) for c in TYPES]), path)
    checked = q.dq(apply_types(read_delimited(spark, path), TYPES), CONTRACT)
    listing = io.StringIO()
    with contextlib.redirect_stdout(listing):
        checked.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", listing.getvalue())]
    assert sizes and max(sizes) < 8000


def test_absent_required_column(spark):
    df = spark.createDataFrame([(None,)], "a int")
    with pytest.raises(MissingColumnsError):
        q.dq_missing(df, ["a", "b"])
    assert q.dq_missing(df, ["a", "b"], fail_fast=False).first().dq_missing == ["a"]


def test_empty_contract_makes_every_row_valid(spark):
    df = spark.createDataFrame([(None,)], "a int")
    row = q.dq(df, Contract(types={})).first()
    assert row.dq_valid and row.dq_missing == row.dq_domain == row.dq_range == row.dq_corrupt == []
    assert q.dq_flag(df).first().dq_valid


def test_open_bounds(spark):
    df = spark.createDataFrame([(1, -5), (2, 0), (3, 5), (4, None)], "i int, v int")
    def flagged(low, high):
        return {r.i for r in q.dq_range(df, {"v": (low, high), "absent": (0, 1)}).collect() if r.dq_range}
    assert flagged(0, None) == {1}
    assert flagged(None, 0) == {3}
    assert flagged(-5, 0) == {3}
    assert flagged(None, None) == set()


def test_warnings_are_a_set(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for text in ("late", "rule", "late"):
        df = q.add_warning(df, text)
    assert df.first().pipe_warnings == ["late", "rule"]
    assert q.ensure_warnings(df) is df


def test_a_failing_rule_leaves_a_warning(spark):
    df = spark.createDataFrame([(1,)], "zone int")
    rule = partial(segment, rule=SEGMENT_RULE, out="strategic")
    row = q.apply_rule_or_warn(df, rule, "strategic", name="segment").first()
    assert row.strategic is None
    assert row.pipe_warnings[0].startswith("RULE_ERROR: segment (MissingColumnsError")
    with pytest.raises(MissingColumnsError):
        q.apply_rule_or_warn(df, rule, "strategic", fail=True)


def test_a_rule_that_cannot_be_analysed_leaves_a_warning(spark):
    df = spark.createDataFrame([(1,)], "zone int")
    out = q.apply_rule_or_warn(df, lambda d: d.withColumn("x", F.col("nope")), "x", kind="int")
    assert dict(out.dtypes)["x"] == "int"
    assert "UNRESOLVED_COLUMN" in out.first().pipe_warnings[0]
