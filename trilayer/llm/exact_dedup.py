"""Exact dedup by a tree merge of sorted digest runs. DataFrame operations only.

Each input partition is a run. Its rows are reduced to one entry per digest, then runs
are merged in rounds: run r joins group r / fan_in, entries of equal digests meet, and
the smallest (or largest) identifier of each stays. After the last round one run holds
every digest once. A run is a key, not a task: its digests are spread over all tasks,
so the last run is no bottleneck, and a text that repeats a million times is one entry
per run after the first, map-side, step.

An entry is verified by three facts of the text: SHA-256, a 64-bit hash of another
family and the length in bytes. Texts that differ in any are never merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm.common import ROW, located, store, table, without_rows

FAN_IN = 8
_PROOF = ["_sha", "_other", "_bytes"]


def _best(keep: str) -> Column:
    best = F.max if keep == "largest" else F.min
    return best("_best").alias("_best")


def exact_groups(
    docs: DataFrame,
    keep: str = "smallest",
    normalise: Column | None = None,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when `normalise` (default: the text as it is, null as empty) gives
    equal strings. Of equal texts the row with the smallest or largest doc_id stays; of
    rows that also share the doc_id exactly one. A null doc_id stays only where the
    group has no other; keep_id is then null. An empty table gives no rows. Other
    columns of `docs` are not read, so their names cannot clash.
    """
    row = F.monotonically_increasing_id()
    return _grouped(docs, row, keep, normalise, fan_in).select(
        F.col("_id").alias("doc_id"),
        F.col("_kept.id").alias("keep_id"),
        F.col("_total").alias("group_size"),
        _stays().alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of `docs` that stay, all columns whatever their names. Only digests and the
    names of rows are shuffled, and the rows that may have to go."""
    rows = located(docs)
    grouped = _grouped(rows, F.col(ROW), keep, None, FAN_IN)
    return without_rows(rows, grouped.filter(~_stays()).select(F.col("_best.row").alias(ROW)))


def _stays() -> Column:
    return F.col("_best.row") == F.col("_kept.row")


def _grouped(docs: DataFrame, row: Column, keep: str, normalise: Column | None, fan_in: int) -> DataFrame:
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    text = F.coalesce(F.col("text") if normalise is None else normalise, F.lit(""))
    known = F.col("doc_id").isNotNull()
    first = ~known if keep == "smallest" else known
    rows = store(
        docs.select(
            F.col("doc_id").alias("_id"),
            F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("_sha"),
            F.xxhash64(text).alias("_other"),
            F.octet_length(text).alias("_bytes"),
            F.spark_partition_id().alias("_run"),
            F.struct(first.alias("a"), F.col("doc_id").alias("id"), row.alias("row")).alias("_best"),
        ),
        "digests",
    )
    merged = leaves = store(
        rows.groupBy("_run", *_PROOF)
        .agg(_best(keep), F.count(F.lit(1)).alias("_size"))
        .sortWithinPartitions("_run", *_PROOF),
        "runs",
    )
    runs = (rows.agg(F.max("_run")).first()[0] or 0) + 1
    while runs > 1:
        merged = store(
            merged.groupBy(F.floor(F.col("_run") / fan_in).cast("int").alias("_run"), *_PROOF)
            .agg(_best(keep), F.sum("_size").alias("_size"))
            .sortWithinPartitions("_run", *_PROOF),
            "runs",
        )
        runs = -(-runs // fan_in)
    # Back down: to the entry of each leaf run, then to the rows of that run, so that
    # copies of one text are spread over as many keys as there are runs.
    root = merged.select(*_PROOF, F.col("_best").alias("_kept"), F.col("_size").alias("_total"))
    answers = leaves.select("_run", *_PROOF).join(root, _PROOF)
    return rows.join(answers, ["_run", *_PROOF])


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


OP6_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""
