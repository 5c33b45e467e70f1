"""Projections: typing, column checks, simple column rewrites."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.numbers import double_of, int_of, normalize_number, safe_int


class MissingColumnsError(ValueError):
    """A required column is not in the schema."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail, naming them, if columns are absent. Reads the schema, runs no job."""
    have = set(df.columns)
    missing = [c for c in columns if c not in have]
    if missing:
        raise MissingColumnsError(f"missing columns: {missing}")
    return df


def require_non_empty(df: DataFrame, message: str) -> DataFrame:
    """Fail if there is no row. One limit-1 job."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def flagged_names(conditions: Sequence[tuple[str, Column]]) -> Column:
    """Array of the names whose condition holds.

    The lambda inside `array_compact` keeps the fault arrays out of the generated
    method that does the typing. Fused into it (as `array_remove` would be) the
    method passes 8000 bytes with the full contract, the JVM no longer compiles it,
    and the stage runs three times slower.
    """
    if not conditions:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in conditions]))


def apply_types(
    df: DataFrame, types: Mapping[str, str], unparsed: str | None = None
) -> DataFrame:
    """Type the listed columns that exist and leave the others alone.

    `unparsed` names an optional array column listing the columns that held text
    which did not parse.
    """
    have = set(df.columns)
    present = {name: kind for name, kind in types.items() if name in have}
    if not present and not unparsed:
        return df
    # Normalized first, in a projection of their own: the typing names each text several
    # times, and written out as often it would pass the size the JVM compiles.
    texts = {name: f"_text_{name}" for name in present}
    df = df.withColumns({text: normalize_number(F.col(name)) for name, text in texts.items()})
    typed = {
        name: double_of(F.col(texts[name])) if kind == "double" else int_of(F.col(texts[name]), kind)
        for name, kind in present.items()
    }
    if unparsed:
        typed[unparsed] = flagged_names(
            [(name, (F.trim(F.col(name).cast("string")) != "") & typed[name].isNull()) for name in present]
        )
    return df.withColumns(typed).drop(*texts.values())


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip white space around every column name; names must stay distinct."""
    return df.toDF(*stripped_names(df.columns))


def stripped_names(names: Sequence[str]) -> list[str]:
    stripped = [name.strip() for name in names]
    folded = [name.lower() for name in stripped]
    repeated = sorted({name for name in stripped if folded.count(name.lower()) > 1})
    if repeated:
        raise ValueError(f"column names repeat once stripped: {repeated}")
    return stripped


def restrict_to(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    """Keep rows whose column is one of the values; prunes partitions if it is one."""
    return df.filter(F.col(column).isin(list(values)))


def valid_rows(df: DataFrame, flag: str = "dq_valid") -> DataFrame:
    return df.filter(F.col(flag)).drop(flag)


def invalid_rows(df: DataFrame, flag: str = "dq_valid") -> DataFrame:
    return df.filter(~F.col(flag)).drop(flag)


def placeholder(df: DataFrame, column: str, kind: str) -> DataFrame:
    """A typed null column, unless the column is already there."""
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(kind))


def with_year(df: DataFrame, year: int, column: str = "yr") -> DataFrame:
    """Overwrite (or add, last) the year, keeping the type of an existing column."""
    kind = df.schema[column].dataType if column in df.columns else "int"
    return df.withColumn(column, F.lit(year).cast(kind))


def fallback_label(df: DataFrame, code: str, label: str, unknown: str) -> DataFrame:
    """If the label column is absent, use the code as text, null as `unknown`."""
    if code not in df.columns or label in df.columns:
        return df
    text = safe_int(F.col(code)).cast("string")
    return df.withColumn(label, F.coalesce(text, F.lit(unknown)))
