"""Boolean text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trilayer.fixed_values import TRUE_WORDS


def parse_bool(col: Column) -> Column:
    """True for the accepted words in any case; anything else, null too, is false."""
    word = F.lower(F.trim(col.cast("string")))
    return F.coalesce(word.isin(list(TRUE_WORDS)), F.lit(False))
