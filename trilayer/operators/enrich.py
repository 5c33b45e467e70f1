"""Labels, segments and day flags."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.config import SegmentRule
from trilayer.functions.numbers import safe_int
from trilayer.operators.joins import join_dimension
from trilayer.operators.typing import require_columns


def lookup(
    df: DataFrame, mapping: Mapping[str, str], src: str, dst: str, default: str | None = None
) -> DataFrame:
    """Code to label through a literal map; a code without a label gets `default`.

    For dictionaries of up to a few hundred entries: no join, no shuffle.
    """
    if src not in df.columns or not mapping:
        return df
    pairs = [F.lit(str(part)) for pair in mapping.items() for part in pair]
    label = F.create_map(*pairs)[F.col(src).cast("string")]
    return df.withColumn(dst, label if default is None else F.coalesce(label, F.lit(default)))


def lookup_table(
    df: DataFrame,
    dim: DataFrame,
    src: str,
    dst: str,
    code: str,
    label: str,
    default: str | None = None,
    spread_by: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """Code to label through a dictionary table of any size.

    The dictionary is reduced to one label per code first, so the row count of
    `df` never changes. It is broadcast only if it measures small, `max_rows` at
    most; `spread_by` names the columns that deal out a hot code otherwise (see `join_dimension`).
    """
    key = "_lookup_code"
    labels = (
        dim.filter(F.col(code).isNotNull())
        .groupBy(F.col(code).cast("string").alias(key))
        .agg(F.min(label).alias(dst))
    )
    facts = df.withColumn(key, F.col(src).cast("string"))
    measured = dim.select(code, label)
    joined = join_dimension(
        facts, labels, key, spread_by=spread_by, probe=measured, max_rows=max_rows
    ).drop(key)
    if default is None:
        return joined
    return joined.withColumn(dst, F.coalesce(dst, F.lit(default)))


def codes_matching(dim: DataFrame, code: str, label: str, keywords: Iterable[str]) -> DataFrame:
    """Codes whose label contains any of the keywords, case ignored."""
    text = F.lower(F.col(label))
    hit = F.lit(False)
    for word in keywords:
        hit = hit | text.contains(word)
    return dim.filter(hit).select(code).distinct()


def matching_codes(mapping: Mapping[str, str], keywords: Iterable[str]) -> tuple[int, ...]:
    """The same over a dictionary held in the configuration."""
    words = list(keywords)
    hits = (code for code, text in mapping.items() if any(w in text.lower() for w in words))
    return tuple(sorted(int(code) for code in hits if code.isdigit()))


def _one_of(column: Column, values: Iterable[object]) -> Column:
    """Membership by number where all listed values are whole numbers, else by trimmed text."""
    texts = [str(v).strip() for v in values]
    if all(re.fullmatch(r"-?\d+", t) for t in texts):
        return safe_int(column, "bigint").isin([int(t) for t in texts])
    return F.trim(column.cast("string")).isin(texts)


def segment_column(rule: SegmentRule, read: Callable[[str], Column] = F.col) -> Column:
    """The rule as a boolean column; null logic first, then null to false."""
    branches = [_one_of(read(name), values) for name, values in rule.any_of if values]
    if not branches:
        return F.lit(False)
    name, values = rule.gate
    conditions = [reduce(or_, branches), *([_one_of(read(name), values)] if values else [])]
    return F.coalesce(reduce(and_, conditions), F.lit(False))


def segment(df: DataFrame, rule: SegmentRule, out: str = "strategic") -> DataFrame:
    """Flag the rows of a business segment."""
    require_columns(df, rule.columns)
    return df.withColumn(out, segment_column(rule))


def segment_present(rule: SegmentRule, columns: Iterable[str]) -> SegmentRule:
    """The rule limited to columns that exist: an absent gate is open, others never match."""
    have = set(columns)
    name, values = rule.gate
    return SegmentRule(
        gate=(name, values if name in have else ()),
        any_of=tuple((c, v if c in have else ()) for c, v in rule.any_of),
    )


def day_column(light: Column, codes: Iterable[int]) -> Column:
    """True if the light code is a day code; null, or no codes at all, is not day."""
    codes = list(codes)
    return F.coalesce(light.isin(codes), F.lit(False)) if codes else F.lit(False)


def day_flag(
    df: DataFrame, codes: Iterable[int], light: str = "light", out: str = "is_day"
) -> DataFrame:
    return df.withColumn(out, day_column(F.col(light), codes))


def two_way_label(flag: Column, yes: str, no: str) -> Column:
    """A label for a boolean; null counts as no."""
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def segment_label(
    df: DataFrame, flag: str, yes: str, no: str, out: str = "segment_label"
) -> DataFrame:
    return df.withColumn(out, two_way_label(F.col(flag), yes, no))
