"""Distributions of a measure: histogram, share of zeros, exact percentiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilayer.operators.joins import join_dimension
from trilayer.sinks.scratch import stored


def value_distribution(df: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Rows per group and value."""
    return df.groupBy(*by, measure).agg(F.count(F.lit(1)).alias("n"))


def zero_share(df: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Share of rows whose measure is zero; a null measure is not zero."""
    is_zero = F.when(F.col(measure) == 0, F.lit(1)).otherwise(F.lit(0))
    return df.groupBy(*by).agg(F.avg(is_zero).alias("zero_share"))


def percentiles(
    df: DataFrame, by: Sequence[str], measure: str, points: Mapping[str, float]
) -> DataFrame:
    """Exact interpolated percentiles of a count-like measure.

    The rows are first reduced to a histogram, so the final aggregate holds one
    entry per distinct value of a group and not its rows. For a measure with
    unbounded distinct values use `percentiles_by_rank`.
    """
    histogram = value_distribution(df.filter(F.col(measure).isNotNull()), by, measure)
    return histogram.groupBy(*by).agg(
        *[
            F.percentile(F.col(measure), F.lit(p), F.col("n")).alias(name)
            for name, p in points.items()
        ]
    )


#: A sketch's ranks are off by one row in so many at most.
ACCURACY = 10_000


def percentiles_by_rank(
    df: DataFrame, by: Sequence[str], measure: str, points: Mapping[str, float]
) -> DataFrame:
    """Exact interpolated percentiles of a continuous measure.

    A mergeable sketch brackets the wanted ranks of every group. One more pass counts the rows
    below each bracket and keeps the values inside, so what is sorted is a few of
    `ACCURACY` parts of the rows, whatever the number of distinct values. Null and NaN are
    left out; a group without another value has no row.
    """
    if not by:
        return percentiles_by_rank(df.withColumn("_all", F.lit(0)), ["_all"], measure, points).drop("_all")
    # Plain keys for the joins: as a struct the group also matches where a part of it is null.
    rows = df.select(F.struct(*by).alias("_group"), F.col(measure).alias("_value"))
    rows = rows.filter(F.col("_value").isNotNull() & ~F.isnan(F.col("_value").cast("double")))
    slack = 2 / ACCURACY
    shares = [s for p in points.values() for s in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = F.percentile_approx("_value", shares, ACCURACY).alias("_sketch")
    ends = (F.min("_value").alias("_min"), F.max("_value").alias("_max"))
    sketched = stored(rows.groupBy("_group").agg(sketch, F.count(F.lit(1)).alias("_rows"), *ends), "brackets")

    # In a group of few rows the slack is less than a rank: it is sorted whole.
    few = F.col("_rows") < 2 * ACCURACY
    brackets = []
    for i, p in enumerate(points.values()):
        low = F.when(few | F.lit(p <= slack), F.col("_min")).otherwise(F.col("_sketch")[2 * i])
        high = F.when(few | F.lit(p >= 1 - slack), F.col("_max")).otherwise(F.col("_sketch")[2 * i + 1])
        brackets += [low.alias(f"_low{i}"), high.alias(f"_high{i}")]
    bounds = sketched.select("_group", "_rows", *brackets)
    located = join_dimension(rows, bounds, "_group", "inner", spread_by=["_value"], probe=bounds)
    places = range(len(points))
    inside = reduce(or_, [F.col("_value").between(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in places])
    kept = F.when(inside, F.col("_value")).alias("_kept")
    below = [F.count_if(F.col("_value") < F.col(f"_low{i}")).alias(f"_below{i}") for i in places]
    values = located.groupBy("_group", "_rows", *[f"_low{i}" for i in places], kept).agg(F.count(F.lit(1)).alias("n"), *below)

    # Per group, the values inside the brackets and one row for all others.
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_kept").rowsBetween(Window.unboundedPreceding, -1)
    for i in places:
        counted = F.when(F.col("_kept") >= F.col(f"_low{i}"), F.col("n"))
        first = F.sum(f"_below{i}").over(whole) + F.coalesce(F.sum(counted).over(earlier), F.lit(0))
        values = values.withColumn(f"_first{i}", first)

    def target(p: float) -> Column:
        return F.lit(p) * (F.col("_rows") - 1)

    def value_at(i: int, rank: Column) -> Column:
        first, last = F.col(f"_first{i}"), F.col(f"_first{i}") + F.col("n")
        return F.max(F.when((first <= rank) & (rank < last), F.col("_kept")))

    found = values.filter("_kept is not null").groupBy("_group", "_rows").agg(
        *[value_at(i, F.floor(target(p))).alias(f"_at_low{i}") for i, p in enumerate(points.values())],
        *[value_at(i, F.ceil(target(p))).alias(f"_at_high{i}") for i, p in enumerate(points.values())],
    )
    results = []
    for i, (name, p) in enumerate(points.items()):
        low, high = F.col(f"_at_low{i}"), F.col(f"_at_high{i}")
        # The sketch keeps its promise by construction; a rank it misses must not be a silent null.
        value = low + (high - low) * (target(p) - F.floor(target(p)))
        results.append(F.coalesce(value, F.raise_error(F.lit(f"{name}: rank outside its bracket"))).alias(name))
    return found.select("_group.*", *results)
