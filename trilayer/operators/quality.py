"""Data-quality rules: each adds an array naming the columns that break it.

Every rule is a narrow projection, so a chain of them stays in the scan stage.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.config import Contract
from trilayer.operators.typing import flagged_names, placeholder, require_columns

log = logging.getLogger(__name__)

MISSING, DOMAIN, RANGE, CORRUPT = "dq_missing", "dq_domain", "dq_range", "dq_corrupt"
FAULT_ARRAYS = (MISSING, DOMAIN, RANGE, CORRUPT)
VALID = "dq_valid"
WARNINGS = "pipe_warnings"
CORRUPT_RECORD = "_corrupt_record"


def dq_missing(df: DataFrame, required: Iterable[str], fail_fast: bool = True) -> DataFrame:
    """List required columns that are null; absent ones fail, or warn and are left out."""
    required = list(required)
    if fail_fast:
        require_columns(df, required)
    have = set(df.columns)
    absent = [c for c in required if c not in have]
    if absent:
        log.warning("required columns are absent and not checked: %s", absent)
    checks = [(c, F.col(c).isNull()) for c in required if c not in absent]
    return df.withColumn(MISSING, flagged_names(checks))


def dq_domain(df: DataFrame, domains: Mapping[str, Iterable[object]]) -> DataFrame:
    """List columns holding a value outside their allowed set; null passes."""
    have = set(df.columns)
    checks = [
        (c, ~F.col(c).isin(sorted(allowed)))
        for c, allowed in domains.items()
        if c in have and allowed
    ]
    return df.withColumn(DOMAIN, flagged_names(checks))


def dq_range(
    df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]
) -> DataFrame:
    """List columns outside their inclusive bounds; null passes."""
    have, checks = set(df.columns), []
    for c, (low, high) in ranges.items():
        if c not in have:
            continue
        if low is not None and high is not None:
            checks.append((c, ~F.col(c).between(low, high)))
        elif low is not None:
            checks.append((c, F.col(c) < F.lit(low)))
        elif high is not None:
            checks.append((c, F.col(c) > F.lit(high)))
    return df.withColumn(RANGE, flagged_names(checks))


def dq_corrupt(df: DataFrame) -> DataFrame:
    """Flag lines the text reader could not fit to the header."""
    checks = (
        [(CORRUPT_RECORD, F.col(CORRUPT_RECORD).isNotNull())]
        if CORRUPT_RECORD in df.columns
        else []
    )
    return df.withColumn(CORRUPT, flagged_names(checks))


def dq_flag(df: DataFrame) -> DataFrame:
    """Valid means that all fault arrays are empty; an absent array is created empty."""
    empty = F.array().cast("array<string>")
    have = set(df.columns)
    absent = {c: empty for c in FAULT_ARRAYS if c not in have}
    if absent:
        df = df.withColumns(absent)
    clean = F.lit(True)
    for c in FAULT_ARRAYS:
        clean = clean & (F.size(c) == 0)
    return df.withColumn(VALID, F.coalesce(clean, F.lit(False)))


def dq(df: DataFrame, contract: Contract) -> DataFrame:
    """All rules of a contract, then the verdict.

    The totals are attached as observed metrics, named `dq_totals-...`, for query
    listeners (a retried task may count twice; `dq_totals` is exact). Being there
    they also keep a filter on the verdict above the typing: pushed below, it would
    parse every checked column once more, in a method too large for the JVM to
    compile (ten times slower).
    """
    name = f"dq_totals-{uuid.uuid4().hex[:8]}"
    return (
        df.transform(dq_missing, contract.required, contract.fail_fast)
        .transform(dq_domain, contract.domains)
        .transform(dq_range, contract.ranges)
        .transform(dq_corrupt)
        .transform(dq_flag)
        .observe(name, *_totals(VALID))
    )


def _totals(flag: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(flag)).alias("good"),
        F.count_if(~F.col(flag)).alias("bad"),
    ]


def dq_totals(df: DataFrame, flag: str = VALID) -> DataFrame:
    """One row: total, good, bad."""
    return df.agg(*_totals(flag))


def add_warning(df: DataFrame, text: str) -> DataFrame:
    """Append to the set of pipeline warnings, creating it if absent."""
    before = F.col(WARNINGS) if WARNINGS in df.columns else F.array().cast("array<string>")
    return df.withColumn(WARNINGS, F.array_distinct(F.concat(before, F.array(F.lit(text)))))


def ensure_warnings(df: DataFrame) -> DataFrame:
    """The warnings array, empty if no rule failed, so the schema never drifts."""
    if WARNINGS in df.columns:
        return df
    return df.withColumn(WARNINGS, F.array().cast("array<string>"))


def apply_rule_or_warn(
    df: DataFrame,
    rule: Callable[[DataFrame], DataFrame],
    out: str,
    kind: str = "boolean",
    name: str = "rule",
    fail: bool = False,
) -> DataFrame:
    """Apply a rule; if its plan cannot be built, warn and leave a null column.

    Only errors of building or analysing the plan are caught here. Errors in the
    data surface when the frame is written.
    """
    try:
        result = rule(df)
        result.schema  # noqa: B018  (forces analysis inside the try)
        return result
    except Exception as error:
        log.error("rule %s failed: %s", name, error)
        if fail:
            raise
        # The first line only: analyser messages carry the whole plan below it.
        reason = (str(error).splitlines() or [""])[0]
        warned = add_warning(df, f"RULE_ERROR: {name} ({type(error).__name__}: {reason})")
        return placeholder(warned, out, kind)
