"""Bronze to silver: type, check and split."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from trilayer.config import Contract, SourceSpec
from trilayer.operators.quality import CORRUPT_RECORD, dq
from trilayer.operators.typing import apply_types, require_non_empty
from trilayer.plans.incidents import CONTRACT, YEAR
from trilayer.sinks.tables import SplitTotals, split_write
from trilayer.sources.delimited import read_sources

log = logging.getLogger(__name__)


def checked_rows(bronze: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """Typed rows with their fault arrays and verdict: one projection over the scan."""
    checked = bronze.transform(apply_types, contract.types).transform(dq, contract)
    return checked.drop(CORRUPT_RECORD)


def run_silver(
    spark: SparkSession,
    sources: Sequence[SourceSpec],
    silver_path: str,
    contract: Contract = CONTRACT,
    run_ts: datetime | None = None,
    cluster: bool = False,
) -> SplitTotals:
    """Read the landing text once and write both sides of the split table."""
    bronze = require_non_empty(read_sources(spark, sources, run_ts=run_ts), "the landing is empty")
    totals = split_write(checked_rows(bronze, contract), silver_path, YEAR, cluster=cluster)
    log.info("silver: %d rows, %d valid, %d quarantined", totals.total, totals.good, totals.bad)
    return totals
