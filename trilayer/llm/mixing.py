"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed by cell (source, language, topic); raking multiplies the cells by
one factor per value of each margin, in turn, until every margin has its target share.
A document is then kept with its cell's calibrated rate, by a draw that depends on its
id alone. Values no target names share the margin's rest, so there are no more cells
than the targets, given by the caller, span.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.functions import hash_uniform
from trilayer.llm.common import table

log = logging.getLogger(__name__)

OTHER = "(other)"
ROUNDS, TOLERANCE = 1000, 1e-9
#: Shares that are still further off after all rounds contradict each other.
WORST = 1e-4
Targets = Mapping[str, Mapping[str, float]]

#: Shares of tokens by margin; what they leave goes to all other values together.
TARGETS: Targets = {
    "source": {"src0": 0.10},
    "lang": {"en": 0.60, "de": 0.15, "fr": 0.15, "es": 0.10},
    "topic": {"prose": 0.966, "tabular": 0.031, "brief": 0.003},
}


def word_count(text: Column) -> Column:
    """Words of a text, the token weight of a document."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\s]+")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """The form of a text stands for its topic: cells of tables, a few words, or prose."""
    return F.when(F.contains(text, F.lit(" | ")), "tabular").when(tokens < 60, "brief").otherwise("prose")


def margin_value(column: Column, target: Mapping[str, float]) -> Column:
    """The value if a target names it, else `OTHER`; null is `OTHER` too."""
    return F.when(column.isin(*target), column).otherwise(OTHER) if target else F.lit(OTHER)


def rake(cells: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS, strict: bool = False) -> np.ndarray:
    """Factors of the cells of a contingency table so that its margins have the target shares.

    Target shares of values without tokens are dealt to the others in proportion. Margins
    that no weights of the cells with tokens can meet are an error if `strict`; else a
    warning says how far off the last round's factors are, and those are returned.
    """
    weight = cells.astype(float) / max(cells.sum(), 1)
    start = weight.copy()
    axes = range(cells.ndim)
    goals = []
    for axis, target in zip(axes, targets):
        present = start.sum(axis=tuple(a for a in axes if a != axis)) > 0
        goal = np.where(present, target, 0.0)
        goals.append(goal / goal.sum() if goal.sum() > 0 else present / max(present.sum(), 1))
    for _ in range(rounds):
        worst = 0.0
        for axis, goal in zip(axes, goals):
            share = weight.sum(axis=tuple(a for a in axes if a != axis))
            factor = np.divide(goal, share, out=np.zeros_like(goal), where=share > 0)
            worst = max(worst, np.abs(share - goal).max())
            weight = weight * factor.reshape([-1 if a == axis else 1 for a in axes])
        if worst < TOLERANCE:
            break
    else:
        if worst > WORST:
            said = f"the target margins contradict the cells that hold tokens: off by {worst:.2g}"
            if strict:
                raise ValueError(said)
            log.warning(said)
    return np.divide(weight, start, out=np.zeros_like(weight), where=start > 0)


def calibrated(
    docs: DataFrame, targets: Targets = TARGETS, share: float | None = None, seed: int = 0, strict: bool = False
) -> DataFrame:
    """All columns of `docs` in the struct `doc`, with tokens, probability and kept.

    Rates are the raking factors, scaled so that the most wanted cell is kept whole, or
    to keep `share` of all tokens, where rates above one are cut to one. A text without
    words weighs nothing and has the rate of its cell, or 1 if its cell has no tokens.
    Rows with the same doc_id share a draw; a null doc_id draws like any other. Margins that
    the rows cannot meet, as in a small table, are met as nearly as raking can, with a warning,
    or are an error if `strict`.
    """
    tokens = word_count(F.col("text"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        tokens.alias("tokens"),
        margin_value(F.col("source"), targets["source"]).alias("source"),
        margin_value(F.col("lang"), targets["lang"]).alias("lang"),
        margin_value(topic_of(F.col("text"), tokens), targets["topic"]).alias("topic"),
    )
    values = {m: [*t, OTHER] for m, t in targets.items()}
    shares = [np.array([*t.values(), max(0.0, 1 - sum(t.values()))]) for t in targets.values()]
    cells = np.zeros([len(v) for v in values.values()])
    # No more rows than the targets have combinations.
    for r in rows.groupBy(*values).agg(F.sum("tokens").alias("tokens")).collect():
        cells[tuple(values[m].index(r[m]) for m in values)] = r["tokens"]
    factors = rake(cells, shares, strict=strict)
    rates = factors / max(factors.max(), 1e-300)
    if share is not None:
        low, high = 0.0, 1 / max(rates[rates > 0].min(initial=1.0), 1e-12)
        for _ in range(100):
            middle = (low + high) / 2
            kept = (np.minimum(rates * middle, 1) * cells).sum()
            low, high = (middle, high) if kept < share * cells.sum() else (low, middle)
        rates = np.minimum(rates * high, 1)
    rates = np.where(cells > 0, rates, 1.0)
    listed = [
        (*(values[m][i] for m, i in zip(values, at)), float(rates[at])) for at in np.ndindex(*cells.shape)
    ]
    names = [*values, "probability"]
    spark = docs.sparkSession
    by_cell = spark.createDataFrame(listed, ", ".join(f"{n} string" for n in values) + ", probability double")
    drawn = rows.join(F.broadcast(by_cell.select(*names)), list(values), "left")
    draw = hash_uniform(seed, "mixing", F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("")))
    return drawn.withColumn("kept", draw < F.col("probability"))


def mix_sources(docs: DataFrame, targets: Targets = TARGETS, share: float | None = None) -> DataFrame:
    """The sampled rows of `docs`, all columns."""
    return calibrated(docs, targets, share).filter("kept").select("doc.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calibrated(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc.doc_id", F.col("source").alias("source_margin"), F.col("lang").alias("lang_margin"),
        F.col("topic").alias("topic_margin"), "tokens", "probability", "kept",
    )
