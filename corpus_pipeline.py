"""The corpus pipeline: stages over documents, each written and read again.

Every stage but the last returns rows of its predecessor, all columns as they were.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from trilayer.llm.common import store, table
from trilayer.llm.exact_dedup import drop_copies
from trilayer.llm.mixing import mix_sources
from trilayer.llm.near_dedup import drop_near_copies
from trilayer.llm.packing import pack
from trilayer.llm.toxicity import drop_toxic, fit_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Rows that go to a Python worker at once. Whole texts are wide: the default of ten times as
#: many is held several times over, by the engine and by the worker of every task.
BATCH_ROWS = 1000


def in_small_batches(stage: Stage) -> Stage:
    """Set the session's batch size first. It stays, as the stage's result runs after it returns."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models call toxic go."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: that with the largest doc_id."""
    return drop_copies(docs, keep="largest")


@in_small_batches
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest doc_id."""
    return drop_near_copies(docs)


@in_small_batches
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose margins have the target weights."""
    return mix_sources(docs)


@in_small_batches
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their place in training sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Learned scores, sketches and raking are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
