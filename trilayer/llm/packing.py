"""Packing documents into training sequences as a cutting-stock problem.

A document's ids are cut into full sequences and a remainder. The remainders are the
orders of a cutting-stock problem: the histogram of their lengths, in units of a few
ids, is all the plan needs. A linear program over patterns (how many pieces of each
length share a sequence) is solved by column generation: the duals price a knapsack,
solved by dynamic programming over the capacity, whose best pattern enters the basis.
The rounded-down patterns and a first-fit-decreasing plan of what is left are then
handed to the pieces by their rank within their length class.

The plan is bounded by the number of length classes, whatever the corpus holds. Ranks
come from counts per task, not from a sort, so no class or group of equal lengths meets
in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.llm.common import store, table
from trilayer.llm.tokens import text_ids, word_ids

CAPACITY = 2048
#: Ids per unit of the histogram: 256 length classes for sequences of 2048.
UNIT = 8
#: The program stops when its value is this close to its lower bound.
GAP = 0.002
#: Steps after which it stops anyway; its plan is then valid, with a little more padding.
STEPS_PER_CLASS = 4
END_ID = 1
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable counts of items within the capacity."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = sizes <= room
        gain = np.where(fits, values + best[np.where(fits, room - sizes, 0)], -1.0)
        item = int(gain.argmax())
        best[room] = best[room - 1]
        if gain[item] > best[room] + 1e-12:
            best[room], chosen[room] = gain[item], item
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            counts[chosen[room]] += 1
            room -= int(sizes[chosen[room]])
    return float(best[capacity]), counts


def _times(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A product of a matrix and a vector, either way round. Not by a linear algebra library:
    its threads have been seen to block in a driver that runs a JVM beside it."""
    return (left * right).sum(axis=1) if left.ndim == 2 else (left[:, None] * right).sum(axis=0)


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """By Gauss-Jordan elimination with row exchanges."""
    n = len(matrix)
    work = np.concatenate((matrix.astype(float), np.eye(n)), axis=1)
    for column in range(n):
        pivot = column + int(np.abs(work[column:, column]).argmax())
        work[[column, pivot]] = work[[pivot, column]]
        work[column] /= work[column, column]
        others = np.flatnonzero(work[:, column])
        others = others[others != column]
        work[others] -= work[others, column][:, None] * work[column]
    return work[:, n:]


def solve_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often the linear program cuts each (fractional).

    The program: fewest patterns that cover the demand. It starts from pairs of sizes that
    fill a sequence; a surplus column stands for pieces cut beyond the demand. Prices are
    drawn towards those of a perfect packing, `size / capacity`, which shortens the search.
    """
    classes = len(sizes)
    place = {int(s): i for i, s in enumerate(sizes)}
    basis, cost = np.diag(np.floor(capacity / sizes)), np.ones(classes)
    for item, size in enumerate(sizes):
        partner = place.get(int(capacity - size))
        if partner is None or partner >= item:
            continue
        basis[item, item], basis[partner, item] = 1, 1
        if demand[item] > demand[partner]:
            basis[:, partner], cost[partner] = 0, 0
            basis[partner, partner] = -1
    inverse = inverse_of(basis)
    amount = np.maximum(_times(inverse, demand), 0)
    center = sizes / capacity
    bound = float((demand * center).sum())
    for step in range(1, STEPS_PER_CLASS * classes + 100):
        prices = _times(cost, inverse)
        if prices.min() < -1e-9:
            item = int(prices.argmin())
            counts, price = np.zeros(classes), 0.0
            counts[item] = -1
        else:
            for weight in (0.9, 0.5, 0.0):
                mixed = np.maximum(weight * center + (1 - weight) * prices, 0)
                value, counts = best_pattern(sizes, mixed, capacity)
                if (counts * prices).sum() > 1 + 1e-6:
                    break
            price = 1.0
            lower = float((demand * mixed).sum()) / max(value, 1.0)
            if lower > bound:
                bound, center = lower, mixed / max(value, 1.0)
            if (counts * prices).sum() <= 1 + 1e-6 or (cost * amount).sum() <= bound * (1 + gap):
                break
        direction = _times(inverse, counts)
        enters = direction > 1e-9
        if not enters.any():
            break
        ratio = np.where(enters, amount / np.where(enters, direction, 1), np.inf)
        leaving = int(ratio.argmin())
        basis[:, leaving], cost[leaving] = counts, price
        if step % 50:
            inverse[leaving] /= direction[leaving]
            others = np.arange(classes) != leaving
            inverse[others] -= direction[others][:, None] * inverse[leaving]
        else:
            inverse = inverse_of(basis)
        amount = np.maximum(_times(inverse, demand), 0)
    patterns = cost > 0
    return basis[:, patterns], amount[patterns]


def first_fit_decreasing(sizes: np.ndarray, left: np.ndarray, capacity: int) -> Iterator[tuple[np.ndarray, int]]:
    """Patterns and their multiples for the remaining counts, largest pieces first."""
    left = left.copy()
    while left.any():
        counts, room = np.zeros(len(sizes), np.int64), capacity
        for item in np.argsort(-sizes):
            take = min(int(left[item]), room // int(sizes[item]))
            counts[item] = take
            room -= take * int(sizes[item])
        used = counts > 0
        times = int((left[used] // counts[used]).min())
        left -= times * counts
        yield counts, times


def plan_sequences(histogram: dict[int, int], capacity: int, gap: float = GAP) -> tuple[np.ndarray, int]:
    """For each size the ranks that each pattern takes, ascending, and the number of sequences.

    `histogram`: pieces by size in units. Rows: size, first rank, pieces per sequence,
    first sequence.
    """
    rows: list[tuple[int, int, int, int]] = []
    if not histogram:
        return np.zeros((0, 4), np.int64), 0
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[s] for s in sizes], np.int64)
    basis, amount = solve_patterns(sizes, demand.astype(float), capacity, gap)
    left, ranks, sequences = demand.copy(), np.zeros(len(sizes), np.int64), 0

    def cut(counts: np.ndarray, times: int) -> None:
        nonlocal sequences
        for item in np.flatnonzero(counts):
            rows.append((int(sizes[item]), int(ranks[item]), int(counts[item]), sequences))
        ranks[:] += times * counts
        left[:] -= times * counts
        sequences += times

    for pattern, times in zip(basis.T.round().astype(np.int64), np.floor(amount + 1e-9).astype(np.int64)):
        used = pattern > 0
        times = min(int(times), int((left[used] // pattern[used]).min()))
        if times > 0:
            cut(pattern, times)
    for counts, times in list(first_fit_decreasing(sizes, left, capacity)):
        cut(counts, times)
    rows.sort()
    return np.array(rows, np.int64), sequences


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, unit: int, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their size class and their rank within task and class."""
    schema = f"{PIECE}, size int, run int, local_rank long" + ", ids array<int>" * keep_ids
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, run = word_ids(tokenizer), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            for i, found in enumerate(text_ids(batch.column(1), words)):
                ids = found.tobytes() + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    size = -(-len(part) // (4 * unit))
                    rank = seen.get(size, 0)
                    seen[size] = rank + 1
                    row = (i, start, len(part) // 4, zlib.crc32(part), total, size, run, rank)
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if keep_ids else row)
            if not rows:
                continue
            at, *columns = zip(*rows)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()] + [pa.list_(pa.int32())] * keep_ids
            arrays = [batch.column(0).take(pa.array(at, pa.int64()))]
            arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    unit: int = UNIT,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and `ids` if asked for).

    A document's ids are those of its whole text followed by `END_ID`; a null or empty
    text is that id alone. Every id lies in one piece. Repeated rows and null ids are
    documents of their own. An empty table gives no rows. Other columns are not read.
    `tokenizer` is a file that every executor has at the same path.
    """
    if capacity % unit:
        raise ValueError("the unit must divide the capacity")
    spark = docs.sparkSession
    pieces = store(cut_pieces(docs, tokenizer or default_tokenizer(), capacity, unit, keep_ids), "pieces")
    per_run = pieces.groupBy("run", "size").agg(F.count(F.lit(1)).alias("n"))
    per_run = store(per_run, "piece-counts")
    # At most capacity / unit rows.
    histogram = {r["size"]: r["n"] for r in per_run.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan_sequences(histogram, capacity // unit)
    plan = spark.sparkContext.broadcast((rows[:, 0] * 2.0**40 + rows[:, 1], rows))

    def sequenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, steps = plan.value
        for batch in batches:
            size, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "rank"))
            _, first, each, base = steps[np.searchsorted(keys, size * 2.0**40 + rank, side="right") - 1].T
            yield batch.append_column("sequence_id", pa.array(base + (rank - first) // each))

    earlier = Window.partitionBy("size").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = per_run.select("run", "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["run", "size"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    placed = ranked.mapInArrow(sequenced, T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType())]))
    # A sequence has at most `capacity` pieces.
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "run", "size", "local_rank")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
        *["ids"] * keep_ids,
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
