"""Joining a dimension that is usually small, without assuming that it is."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
#: A key with more than this share of the facts is dealt out, and so are fewer than 1000 keys.
HEAVY_SHARE = 1 / 1000
#: Fewer rows of a key are never worth dealing out.
HEAVY_ROWS = 1000
#: Items a sketch holds: the error of a count, at most 3.5 rows in as many, is far below the share.
TRACKED = 16_384
_SALT, _SALTS, _HEAVY = "_salt", "_salts", "_heavy"


def fits_broadcast(dim: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Measure the dimension: rows and widths, summed in each task before one row of it moves."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in dim.columns]
    width = reduce(lambda a, b: a + b, widths)
    probe = dim.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return probe["rows"] <= (BROADCAST_MAX_ROWS if max_rows is None else max_rows) and probe["bytes"] <= (
        BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    )


def heavy_keys(facts: DataFrame, key: str) -> DataFrame | None:
    """Hashes of the keys, that of null included, that hold a large share of the facts, each
    with its number of salts; none is None.

    One pass over the key column: each task keeps a frequent-items sketch of fixed size, and
    sketches are merged. A count can be off by a thousandth of a heavy one's share, which
    moves the number of salts and no result.
    """
    name = F.col(f"`{key}`")
    found = facts.select(F.xxhash64(F.struct(name)).alias(_HEAVY)).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k({_HEAVY}, {TRACKED // 16}, {TRACKED})").alias("top")
    ).first()
    unit = max(HEAVY_ROWS, found["rows"] * HEAVY_SHARE)
    heavy = [(r["item"], -int(-r["count"] // unit)) for r in found["top"] or [] if r["count"] > unit]
    return facts.sparkSession.createDataFrame(heavy, f"{_HEAVY} long, {_SALTS} int") if heavy else None


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    spread_by: Sequence[str] = (),
    probe: DataFrame | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Join a dimension with one row per key: broadcast if it measures small, else shuffled.

    Beyond the bound a key, or null, may hold most of the facts. Such keys are found by a
    sketch and dealt out over as many salts as their rows need; only their rows of the dimension are
    copied, all others are shuffled once. The salt is a hash of the `spread_by` columns (all
    plain columns by default; name a row id to read no others), so a recomputed task repeats
    it. Rows that agree in all of them, copies of one row, are left to adaptive skew join.

    `probe` is a cheaper frame to measure instead, with no fewer or narrower rows.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a dimension is joined left or inner, not {how}")
    if fits_broadcast(dim if probe is None else probe, max_rows, max_bytes):
        return facts.join(F.broadcast(dim), key, how)
    heavy = heavy_keys(facts, key)
    if heavy is None:
        return facts.join(dim, key, how)
    names = list(spread_by) or [
        f.name for f in facts.schema.fields if isinstance(f.dataType, T.AtomicType)
    ]
    spread = F.xxhash64(*[F.col(f"`{n}`") for n in names])
    is_heavy = F.xxhash64(F.struct(F.col(f"`{key}`"))) == F.col(_HEAVY)
    salts = F.coalesce(_SALTS, F.lit(1))
    dealt = facts.join(F.broadcast(heavy), is_heavy, "left")
    dealt = dealt.withColumn(_SALT, F.pmod(spread, salts).cast("int")).drop(_HEAVY, _SALTS)
    copies = dim.join(F.broadcast(heavy), is_heavy, "left")
    copies = copies.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1))).drop(_HEAVY, _SALTS)
    return dealt.join(copies, [key, _SALT], how).drop(_SALT)
