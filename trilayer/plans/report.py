"""Base year against scenario year: every figure the report shows.

The marts are rolled up from the KPI table, a few hundred rows, so a report costs
nothing like a scan of gold. The same marts over raw rows are in
`trilayer.operators.marts`; both give equal figures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer import fixed_values as fixed
from trilayer.functions.flags import parse_bool
from trilayer.operators.enrich import day_column, lookup, two_way_label
from trilayer.operators.marts import MEAN, ROWS, TOTAL, compare, summarise_kpis, to_long
from trilayer.operators.typing import restrict_to
from trilayer.plans.incidents import DAY_CODES, LIGHT, STRATEGIC, YEAR
from trilayer.sinks.tables import write_table
from trilayer.sources.tables import read_partitioned

METRICS = (ROWS, TOTAL, MEAN)


def day_label(light_codes: Sequence[int] = DAY_CODES) -> F.Column:
    return two_way_label(
        day_column(F.col(LIGHT), light_codes), fixed.DAY_LABEL, fixed.NOT_DAY_LABEL
    )


def light_label() -> F.Column:
    return F.coalesce(F.col("light_desc"), F.lit(fixed.UNKNOWN_LABEL))


def segment_text() -> F.Column:
    return two_way_label(
        parse_bool(F.col(STRATEGIC)), fixed.SEGMENT_LABEL, fixed.NOT_SEGMENT_LABEL
    )


def report_marts(kpis: DataFrame, base: int, scenario: int) -> dict[str, DataFrame]:
    """All report tables by name."""
    years = restrict_to(kpis, YEAR, [base, scenario])
    years = lookup(years, fixed.LIGHT_LABELS, LIGHT, "light_desc")
    yearly = summarise_kpis(years, [YEAR])
    daily = summarise_kpis(years, [YEAR, day_label().alias("day_label")])
    return {
        "by_year": yearly,
        "by_year_day": daily,
        "by_year_light": summarise_kpis(years, [YEAR, light_label().alias("light_label")]),
        "by_year_segment": summarise_kpis(years, [YEAR, segment_text().alias("segment_label")]),
        "by_year_long": to_long(yearly, [YEAR], METRICS),
        "comparison": compare(yearly, base, scenario, METRICS),
        "comparison_by_day": compare(daily, base, scenario, (ROWS, MEAN), ["day_label"]),
    }


def run_report(
    spark: SparkSession,
    kpi_path: str,
    report_path: str,
    base: int = fixed.BASE_YEAR,
    scenario: int = fixed.SCENARIO_YEAR,
) -> None:
    """Write each mart as one small table under `report_path`."""
    kpis = read_partitioned(spark, kpi_path)
    for name, mart in report_marts(kpis, base, scenario).items():
        write_table(mart.coalesce(1), f"{report_path}/{name}")
