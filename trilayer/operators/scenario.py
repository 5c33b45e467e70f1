"""What-if tables: resample a base table, mark it, and uplift its outcome.

Every draw is a hash of the row id, so all steps are ordinary columns and one
equi-join, and the result is the same for any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.config import UpliftRates
from trilayer.fixed_values import GROWTH_LIMIT
from trilayer.functions.draws import hash_pick, hash_uniform
from trilayer.functions.numbers import safe_int

DRAW_ID = "draw_id"
DRAWS_PER_TASK = 4_000_000
_BEFORE, _SEGMENT, _DAY, _GAINS = "_before", "_segment", "_day", "_gains"


def scenario_size(n: Column, growth: Column, limit: float = GROWTH_LIMIT) -> Column:
    """Rows to generate: the base count grown by a rate clamped to the limit."""
    clamped = F.greatest(F.lit(-limit), F.least(F.lit(limit), growth))
    return F.round(n * (F.lit(1.0) + clamped)).cast("bigint")


def bootstrap(numbered: DataFrame, n: int, n_out: int, seed: int, row_no: str = "row_no") -> DataFrame:
    """`n_out` draws with replacement from rows numbered 0..n-1.

    The pick is uniform, so the join keys are too: no row is hot before it is
    drawn, whatever the data looks like.
    """
    spark = numbered.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_out // DRAWS_PER_TASK))
    draws = spark.range(0, n_out, 1, tasks).withColumnRenamed("id", DRAW_ID)
    picks = draws.withColumn(row_no, hash_pick(seed, "pick", F.col(DRAW_ID), n))
    return picks.join(numbered, row_no).drop(row_no)


def reassign_ids(df: DataFrame, column: str, start: int, draw_id: str = DRAW_ID) -> DataFrame:
    """New ids start, start+1, ... in the type of the column, if it exists."""
    if column not in df.columns:
        return df
    new_id = F.lit(start).cast("bigint") + F.col(draw_id)
    return df.withColumn(column, new_id.cast(df.schema[column].dataType))


def _whole(df: DataFrame, column: str) -> Column:
    """A whole number wide enough to add to, zero where there is none."""
    wide = safe_int(F.col(column)) if column in df.columns else F.lit(None)
    return F.coalesce(wide.cast("bigint"), F.lit(0).cast("bigint"))


def _has_all(df: DataFrame, parts: Sequence[str]) -> bool:
    return set(parts) <= set(df.columns)


def _sum_of(df: DataFrame, parts: Sequence[str]) -> Column:
    summed = F.lit(0).cast("bigint")
    for part in parts:
        summed = summed + _whole(df, part)
    return summed


def sum_components(df: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """Replace the total by the sum of its parts, not below zero, if they all exist.

    A sum that no int holds is null.
    """
    if not _has_all(df, parts):
        return df
    return df.withColumn(total, F.greatest(F.lit(0), _sum_of(df, parts)).try_cast("int"))


def uplift_probability(rates: UpliftRates, is_segment: Column, is_day: Column, total: Column) -> Column:
    def by_total(pair: tuple[float, float]) -> Column:
        return F.when(total <= 0, F.lit(pair[0])).otherwise(F.lit(pair[1]))

    return (
        F.when(is_segment & is_day, by_total(rates.segment_day))
        .when(is_segment, by_total(rates.segment_other))
        .otherwise(by_total(rates.rest))
    )


def uplift(
    df: DataFrame,
    rates: UpliftRates,
    seed: int,
    is_segment: Column,
    is_day: Column,
    total: str = "casualties",
    parts: Sequence[str] = ("fatal", "serious", "minor"),
    grown_part: str = "minor",
    row_id: str = DRAW_ID,
) -> DataFrame:
    """Add one casualty with a probability by segment, day and zero-or-positive.

    Only rows that gain one are rewritten; the others keep their text as it was. A
    number that outgrows its column's type becomes null.
    """
    if total not in df.columns:
        return df
    # Staged columns: each is used more than once below and is computed once.
    staged = df.withColumns(
        {
            _BEFORE: _sum_of(df, parts) if _has_all(df, parts) else _whole(df, total),
            _SEGMENT: is_segment,
            _DAY: is_day,
        }
    )
    chance = uplift_probability(rates, F.col(_SEGMENT), F.col(_DAY), F.col(_BEFORE))
    staged = staged.withColumn(_GAINS, hash_uniform(seed, "uplift", F.col(row_id)) < chance)

    rewritten = {total: F.greatest(F.lit(0), F.col(_BEFORE) + 1)}
    if grown_part in df.columns:
        rewritten[grown_part] = _whole(df, grown_part) + 1
    return staged.withColumns(
        {
            column: F.when(F.col(_GAINS), value.try_cast(df.schema[column].dataType)).otherwise(
                F.col(column)
            )
            for column, value in rewritten.items()
        }
    ).drop(_BEFORE, _SEGMENT, _DAY, _GAINS)
