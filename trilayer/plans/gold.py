"""Silver to gold: labels, segment flag and the KPI table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from trilayer.config import SegmentRule
from trilayer.operators.enrich import lookup, segment
from trilayer.operators.marts import kpi_mart
from trilayer.operators.quality import apply_rule_or_warn, ensure_warnings
from trilayer.operators.typing import require_non_empty
from trilayer.plans.incidents import KPI_DIMS, LABELS, MEASURE, SEGMENT_RULE, STRATEGIC, YEAR
from trilayer.sinks.tables import write_table
from trilayer.sources.tables import VALID_SIDE, read_partitioned, read_side


def enriched(
    silver: DataFrame, rule: SegmentRule = SEGMENT_RULE, fail_on_rule_error: bool = False
) -> DataFrame:
    """Label columns and the segment flag; a rule that cannot run leaves a warning."""
    for code, label, dictionary in LABELS:
        silver = lookup(silver, dictionary, code, label)
    flagged = apply_rule_or_warn(
        silver,
        partial(segment, rule=rule, out=STRATEGIC),
        out=STRATEGIC,
        name="segment",
        fail=fail_on_rule_error,
    )
    return ensure_warnings(flagged)


def run_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    kpi_path: str,
    rule: SegmentRule = SEGMENT_RULE,
    fail_on_rule_error: bool = False,
    cluster: bool = False,
) -> None:
    """Write the gold table, then its KPIs from the few columns of it they need."""
    silver = require_non_empty(read_side(spark, silver_path, VALID_SIDE), "silver is empty")
    write_table(enriched(silver, rule, fail_on_rule_error), gold_path, YEAR, cluster)
    kpis = kpi_mart(read_partitioned(spark, gold_path), KPI_DIMS, MEASURE)
    write_table(kpis, kpi_path, YEAR, cluster=True)
