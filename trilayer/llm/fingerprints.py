"""Document fingerprints from closed syncmers. DataFrame operations only.

A k-mer is `K` words in a row; its inner substrings are the runs of `INNER` words. It is
an anchor if its smallest inner hash stands at one of its two edges. That depends on the
k-mer alone, not on its surroundings, so a passage keeps its anchors, at a constant
shift, wherever it is moved. A fingerprint is the set of the smallest anchor hashes;
the likeness of two is the share of the smallest of both that both have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilayer.llm.common import table

K, INNER = 5, 2
#: Anchor hashes in a fingerprint.
SKETCH = 64
#: Rows of one stretch of the id order, and the largest number of stretches.
STRETCH_ROWS, MAX_STRETCHES = 2048, 100_000
_STEP = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchors(text: Column) -> Column:
    """Array of (position, hash) of a text's anchors, ascending by position.

    Positions count words; in a text of fewer than `K` words, such as one without blanks,
    they count characters. Fewer than `K` characters are one anchor.
    """

    def of_words(words: Column) -> Column:
        hashed = lambda units: let(F.transform(units, lambda u: F.xxhash64(u)), of_hashes)
        few = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(text).alias("hash")))
        letters = let(F.split(text, ""), lambda units: F.when(F.size(units) >= K, hashed(units)).otherwise(few))
        return F.when(F.size(words) >= K, hashed(words)).when(F.size(words) > 0, letters).otherwise(F.slice(few, 1, 0))

    def of_hashes(h: Column) -> Column:
        inner = F.transform(
            F.sequence(F.lit(0), F.size(h) - INNER),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(INNER)]),
        )
        return let(inner, lambda s: of_inner(h, s))

    def of_inner(h: Column, s: Column) -> Column:
        last = K - INNER

        def at_an_edge(i: Column) -> Column:
            between = F.least(*[F.get(s, i + j) for j in range(1, last)])
            return F.greatest(between, F.least(F.get(s, i), F.get(s, i + last))) == between

        places = F.filter(F.sequence(F.lit(0), F.size(h) - K), at_an_edge)
        return F.transform(
            places,
            lambda i: F.struct(
                i.alias("position"), F.xxhash64(*[F.get(h, i + j) for j in range(K)]).alias("hash")
            ),
        )

    return let(F.filter(F.split(text, r"\s+"), lambda w: w != ""), of_words)


def sketch(text: Column, size: int = SKETCH) -> Column:
    """The `size` smallest distinct anchor hashes, 32 bits each, ascending."""
    low = F.transform(anchors(text), lambda a: a["hash"].bitwiseAND(0xFFFFFFFF))
    return F.slice(F.sort_array(F.array_distinct(low)), 1, size)


def as_text(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def likeness(left: Column, right: Column, size: int = SKETCH) -> Column:
    """Estimate of shared anchors over all anchors; two empty fingerprints are alike."""

    def of_both(union: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(left, right), union))
        return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))

    return let(F.slice(F.sort_array(F.array_union(left, right)), 1, size), of_both)


def _starts(ids: DataFrame) -> list[int]:
    """Smallest ids of stretches of about equal size, ascending. One number per stretch."""
    rows = ids.count()
    parts = max(1, min(MAX_STRETCHES, -(-rows // STRETCH_ROWS)))
    ranged = ids.filter(F.col("doc_id").isNotNull()).repartitionByRange(parts, "doc_id")
    firsts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("doc_id").alias("first"))
    return sorted(r["first"] for r in firsts.collect())


def with_next(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text`, `sketch` and those of the next row by doc_id; the first follows the last.

    Rows are dealt to stretches of the id order, each with a copy of the first rows of
    the stretch after it, so one shuffle of the texts serves and no task sorts all.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    starts = _starts(rows.select("doc_id")) or [0]
    listed = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    coarse = F.split(F.lit(",".join(map(str, starts[::_STEP]))), ",").cast("array<bigint>")
    known = F.coalesce("doc_id", F.lit(-(2**63)))
    block = F.greatest(F.size(F.filter(coarse, lambda s: s <= known)) - 1, F.lit(0)) * _STEP
    within = F.size(F.filter(F.slice(listed, block + 1, _STEP), lambda s: s <= known)) - 1
    rows = rows.withColumn("stretch", F.greatest(block + within, F.lit(0)))
    rows = rows.withColumn("sketch", sketch(F.col("text")))
    opens = (F.col("doc_id") == F.get(listed, F.col("stretch"))) | F.col("doc_id").isNull()
    own = F.struct(F.col("stretch").alias("stretch"), F.lit(False).alias("copy"), F.lit(False).alias("wraps"))
    before = F.struct(
        F.pmod(F.col("stretch") - 1, F.lit(len(starts))).alias("stretch"),
        F.lit(True).alias("copy"),
        (F.col("stretch") == 0).alias("wraps"),
    )
    placed = rows.select(
        "doc_id", "text", "sketch",
        F.explode(F.when(opens, F.array(own, before)).otherwise(F.array(own))).alias("at"),
    )
    order = Window.partitionBy("at.stretch").orderBy("at.wraps", F.asc_nulls_first("doc_id"), "text")
    return placed.select(
        "doc_id", "text", "sketch", "at",
        F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch"),
    ).filter(~F.col("at.copy")).drop("at")


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and the anchors themselves, of every whole text; null is empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", as_text(sketch(text)).alias("fingerprint"), anchors(text).alias("anchors"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    Rows with one doc_id follow each other by text. Null ids come first. A table of one
    row has itself as next. An empty text has an empty fingerprint. Other columns are
    not read.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    changed = with_next(docs).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "sketch",
        "next_sketch",
        edited.alias("edited"),
    )
    sketched = changed.withColumn("edited_sketch", sketch(F.col("edited")))
    return sketched.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
