"""Aggregates, ratios, comparisons and reshapes.

All group-bys are partial plus final hash aggregates, so what is shuffled is one
row per task and group: a year holding most of the rows costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.numbers import safe_int, safe_ratio, zero_fill

ROWS, TOTAL, MEAN = "incidents", "casualties_total", "casualties_mean"


@dataclass(frozen=True)
class Metric:
    """A named aggregate and the column it reads, if any."""

    name: str
    of: Callable[[Column], Column]
    column: str | None = None

    def over(self) -> Column:
        return self.of(F.col(self.column) if self.column else F.lit(1)).alias(self.name)


def aggregated(df: DataFrame, dims: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """The metrics and dimensions whose columns `df` has; no dimension at all is one group."""
    have = set(df.columns)
    measured = [m.over() for m in metrics if m.column is None or m.column in have]
    return df.groupBy(*filter(have.__contains__, dims)).agg(*measured)


def kpi_mart(
    df: DataFrame, dims: Sequence[str], measure: str, prefix: str = "casualties"
) -> DataFrame:
    """Rows, sum and null-skipping average by the dimensions that exist."""
    total, mean = f"{prefix}_total", f"{prefix}_avg"
    metrics = (Metric(ROWS, F.count), Metric(total, F.sum, measure), Metric(mean, F.avg, measure))
    return aggregated(df, dims, metrics)


def summarise(df: DataFrame, dims: Sequence[str | Column], measure: str) -> DataFrame:
    """Rows, total and total per row, where a null measure counts as zero."""
    amount = zero_fill(F.col(measure)) if measure in df.columns else F.lit(0.0)
    grouped = df.groupBy(*dims).agg(F.count(F.lit(1)).alias(ROWS), F.sum(amount).alias(TOTAL))
    return grouped.withColumn(MEAN, safe_ratio(F.col(TOTAL), F.col(ROWS)))


def summarise_kpis(kpis: DataFrame, dims: Sequence[str | Column]) -> DataFrame:
    """The same figures from a KPI table, which is a few hundred rows whatever the facts."""
    total = F.col(TOTAL).cast("double") if TOTAL in kpis.columns else F.lit(None).cast("double")
    grouped = kpis.groupBy(*dims).agg(
        F.sum(ROWS).alias(ROWS), F.sum(F.coalesce(total, F.lit(0.0))).alias(TOTAL)
    )
    return grouped.withColumn(MEAN, safe_ratio(F.col(TOTAL), F.col(ROWS)))


def by_year(df: DataFrame, measure: str = "casualties", year: str = "yr") -> DataFrame:
    """Yearly figures, oldest first; rows without a year are left out."""
    return summarise(df.filter(F.col(year).isNotNull()), [year], measure).orderBy(year)


def by_year_and(
    df: DataFrame, category: Column, name: str, measure: str = "casualties", year: str = "yr"
) -> DataFrame:
    """Yearly figures by one category column."""
    return summarise(df, [year, category.alias(name)], measure)


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide to long: one row per id and metric."""
    as_double = [F.col(m).cast("double").alias(m) for m in metrics]
    return df.select(*ids, *as_double).unpivot(list(ids), list(metrics), "metric", "value")


def compare(
    mart: DataFrame,
    base: int,
    scenario: int,
    metrics: Sequence[str],
    by: Sequence[str] = (),
    year: str = "yr",
) -> DataFrame:
    """Base value, scenario value and their difference per metric (and category).

    The difference is null if either year is absent.
    """
    long = to_long(mart.filter(F.col(year).isin([base, scenario])), [year, *by], metrics)
    sides = long.groupBy(*by, "metric").agg(
        F.max(F.when(F.col(year) == base, F.col("value"))).alias("base_value"),
        F.max(F.when(F.col(year) == scenario, F.col("value"))).alias("scenario_value"),
    )
    return sides.withColumn("delta", F.col("scenario_value") - F.col("base_value"))


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """The most frequent non-null value, the smallest one on ties; no row if none."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.orderBy(F.desc("n"), F.asc(column)).limit(1)


def max_key_column(column: str) -> Column:
    """Aggregate: the largest id that parses, zero if none does."""
    return F.coalesce(F.max(safe_int(F.col(column), "bigint")), F.lit(0).cast("bigint"))


def max_key(df: DataFrame, column: str) -> DataFrame:
    return df.agg(max_key_column(column).alias("max_key"))


def reduction_what_if(
    df: DataFrame, flag: str, measure: str, factor: float, out: str = "reduced"
) -> DataFrame:
    """The measure scaled down on the segment's rows and unchanged elsewhere."""
    scaled = F.when(F.col(flag), F.col(measure) * F.lit(factor)).otherwise(F.col(measure))
    return df.withColumn(out, scaled)
