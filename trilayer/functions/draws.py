"""Random draws that depend on (seed, stream, row id) and nothing else.

`rand(seed)` depends on the partitioning; a hash of the row id does not, so a
rerun on another cluster size, or of a lost task, draws the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hash_number(seed: int, stream: str, row_id: Column, hex_digits: int) -> Column:
    text = F.concat(F.lit(f"{seed}:{stream}:"), row_id.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def hash_uniform(seed: int, stream: str, row_id: Column) -> Column:
    """Uniform in [0, 1) with 32 bits of resolution."""
    return _hash_number(seed, stream, row_id, 8) / F.lit(float(2**32))


def hash_pick(seed: int, stream: str, row_id: Column, n: int) -> Column:
    """Uniform in 0..n-1. Sixty bits, so the modulo bias stays negligible at 10^12 rows."""
    pick = F.pmod(_hash_number(seed, stream, row_id, 15), F.lit(n).cast("bigint"))
    # Never null, so that a join on it adds no null check that hashes again.
    return F.coalesce(pick, F.lit(0).cast("bigint"))
