"""Tolerant number parsing. All of it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_number(col: Column) -> Column:
    """Trimmed text with every decimal comma turned into a dot."""
    return F.replace(F.trim(col.cast("string")), F.lit(","), F.lit("."))


#: Twenty digits before the mark, more than 64 bits need, and eighteen behind it.
_EXACT = "decimal(38,18)"


def _may_be_number(number: Column) -> Column:
    """False for empty text and for what starts beyond the digits, as letters do. A failed cast
    is an exception inside the engine, at several times the cost of a number. A pattern,
    because it adds least to the generated code of every typed column."""
    return number.rlike("^[\\x01-9]")


def double_of(number: Column) -> Column:
    """`safe_double` of normalized text."""
    value = F.when(_may_be_number(number), number.try_cast("double"))
    # NaN sorts above infinity, so one comparison drops both.
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def int_of(number: Column, to: str = "int") -> Column:
    """`safe_int` of normalized text."""
    return F.round(F.when(_may_be_number(number), number.try_cast(_EXACT))).try_cast(to)


def safe_double(col: Column) -> Column:
    """Text to double; anything unparsable, NaN or infinite is null."""
    return double_of(normalize_number(col))


def safe_int(col: Column, to: str = "int") -> Column:
    """Text to a whole number, halves away from zero; overflow is null.

    Read as a decimal, so exact to the last of 64 bits, with or without a fraction mark.
    """
    return int_of(normalize_number(col), to)


def zero_fill(col: Column) -> Column:
    """Text or number to double, null to zero."""
    return F.coalesce(safe_double(col), F.lit(0.0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or null when the denominator is zero."""
    return F.try_divide(numerator, denominator)
