"""The whole run: scenario, silver, gold, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from trilayer import fixed_values as fixed
from trilayer.config import SourceSpec
from trilayer.operators.typing import normalize_headers
from trilayer.plans.gold import run_gold
from trilayer.plans.incidents import scenario_config
from trilayer.plans.report import run_report
from trilayer.plans.scenario import run_scenario
from trilayer.plans.silver import run_silver
from trilayer.sinks.tables import SplitTotals, write_landing


@dataclass(frozen=True)
class Layout:
    """Folders of one installation below a common root (any Hadoop path)."""

    root: str
    base_year: int = fixed.BASE_YEAR
    scenario_year: int = fixed.SCENARIO_YEAR

    def __post_init__(self) -> None:
        if self.base_year == self.scenario_year:
            raise ValueError(f"base and scenario are both {self.base_year}")

    def landing(self, year: int) -> str:
        return f"{self.root}/landing/yr={year}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/incidents"

    @property
    def kpis(self) -> str:
        return f"{self.root}/gold/kpis"

    @property
    def report(self) -> str:
        return f"{self.root}/report"

    def sources(self) -> list[SourceSpec]:
        return [
            SourceSpec((self.landing(self.base_year),), label="base"),
            SourceSpec((self.landing(self.scenario_year),), required=False, label="scenario"),
        ]


def land_base(df: DataFrame, layout: Layout) -> None:
    """Land a raw base-year table as text with clean headers."""
    write_landing(normalize_headers(df), layout.landing(layout.base_year))


def run_all(
    spark: SparkSession, layout: Layout, with_scenario: bool = True, cluster: bool = False
) -> SplitTotals:
    """From the landed base year to the report tables.

    `cluster` gives the fact tables few files per year at the price of a shuffle.
    """
    if with_scenario:
        run_scenario(
            spark,
            layout.landing(layout.base_year),
            layout.landing(layout.scenario_year),
            scenario_config(target_year=layout.scenario_year),
        )
    totals = run_silver(spark, layout.sources(), layout.silver, cluster=cluster)
    run_gold(spark, layout.silver, layout.gold, layout.kpis, cluster=cluster)
    run_report(spark, layout.kpis, layout.report, layout.base_year, layout.scenario_year)
    return totals
