"""Approximate nearest neighbours by learned partitions.

A sample of the vectors gives a neighbour graph, which is cut into partitions of equal size
with few edges between them: halves along the graph's slowest wave, mended by swaps of pairs
of points. A softmax classifier learns, from a vector, in which partitions its neighbours
lie. Every vector is indexed under its most probable partition. A query goes to the most
probable ones until their probability reaches a mass that, on part of the sample kept out
of the training, covers `COVERAGE` of the neighbours; their vectors are reranked by exact
inner products.

The sample is bounded, the index is not: every vector is in it. Partitions and queries are
cut into blocks, so a crowded partition is many tasks. Equal vectors are one point with its
`k` + 1 smallest ids: no answer can hold more of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilayer.llm.common import slices, store, table
from trilayer.operators.joins import join_dimension

K = 20
#: Vectors the graph and the classifier are fitted on, about.
SAMPLE = 8192
#: Neighbours of a point in the graph.
DEGREE = 20
#: Partitions: this share of the square root of the number of points, and at most.
PARTITION_SHARE, MOST_PARTITIONS = 1 / 8, 512
#: Share of a vector's neighbours that the partitions probed for it should hold.
COVERAGE = 0.97
#: Points and queries of a block.
POINT_BLOCK, QUERY_BLOCK = 8192, 2048
_AT_ONCE = 256


@dataclass(frozen=True)
class Router:
    """The classifier and the probability mass that a query probes."""

    weights: np.ndarray
    offsets: np.ndarray
    mass: float

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        z = vectors @ self.weights + self.offsets
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


# --- fitting, on the sample ------------------------------------------------------


def neighbour_graph(vectors: np.ndarray, degree: int) -> np.ndarray:
    """For each row the numbers of the rows with the largest inner product, itself left out."""
    n = len(vectors)
    degree = min(degree, n - 1)
    found = np.empty((n, degree), np.int64)
    for start in range(0, n, _AT_ONCE):
        scores = vectors[start : start + _AT_ONCE] @ vectors.T
        scores[np.arange(len(scores)), np.arange(start, start + len(scores))] = -np.inf
        found[start : start + len(scores)] = np.argpartition(-scores, degree - 1, axis=1)[:, :degree]
    return found


def halve(left: np.ndarray, right: np.ndarray, n: int, first: int, random: np.random.Generator) -> np.ndarray:
    """True for the `first` of `n` points that are to part with the others, cutting few edges."""
    degree = np.maximum(np.bincount(left, minlength=n), 1)
    wave = random.standard_normal(n)
    for _ in range(40):
        wave = wave + np.bincount(left, weights=wave[right], minlength=n) / degree
        wave -= (wave * degree).sum() / degree.sum()
        wave /= np.abs(wave).max() + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(wave, kind="stable")[:first]] = True
    crossing = (side[left] != side[right]).sum()
    for _ in range(20):
        inside = np.bincount(left, weights=np.where(side[left] == side[right], -1.0, 1.0), minlength=n)
        ones, others = np.flatnonzero(side), np.flatnonzero(~side)
        ones, others = ones[np.argsort(-inside[ones], kind="stable")], others[np.argsort(-inside[others], kind="stable")]
        pairs = min(len(ones), len(others))
        worth = int((inside[ones[:pairs]] + inside[others[:pairs]] > 0).sum())
        if not worth:
            break
        # Half of them: partners that both move keep their edge.
        swapped, some = side.copy(), (worth + 1) // 2
        swapped[ones[:some]], swapped[others[:some]] = False, True
        now = (swapped[left] != swapped[right]).sum()
        if now >= crossing:
            break
        side, crossing = swapped, now
    return side


def balanced_partitions(graph: np.ndarray, parts: int, seed: int = 13) -> np.ndarray:
    """A partition for every row of the graph; their sizes differ by few rows."""
    n, degree = graph.shape
    left, right = np.repeat(np.arange(n), degree), graph.ravel()
    left, right = np.concatenate((left, right)), np.concatenate((right, left))
    label, random = np.zeros(n, np.int64), np.random.default_rng(seed)
    todo = [(np.arange(n), parts, 0)]
    while todo:
        points, count, base = todo.pop()
        if count == 1 or len(points) < 2:
            label[points] = base
            continue
        place = np.full(n, -1)
        place[points] = np.arange(len(points))
        edges = (place[left] >= 0) & (place[right] >= 0)
        first = round(len(points) * (count // 2) / count)
        side = halve(place[left[edges]], place[right[edges]], len(points), first, random)
        todo += [(points[side], count // 2, base), (points[~side], count - count // 2, base + count // 2)]
    return label


def fit_classifier(vectors: np.ndarray, goal: np.ndarray, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression on goal distributions, with weight decay, by Adam on all rows."""
    scale = np.sqrt((vectors**2).mean()) + 1e-300
    x = np.column_stack((vectors / scale, np.ones(len(vectors))))
    w, mean, square = (np.zeros((x.shape[1], goal.shape[1])) for _ in range(3))
    for step in range(1, steps + 1):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = x.T @ (p - goal) / len(x) + 1e-4 * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        w = w - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return w[:-1] / scale, w[-1]


def mass_needed(router: Router, queries: np.ndarray, vectors: np.ndarray, coverage: float) -> float:
    """The least mass of probed partitions that hold the given share of all true neighbours."""
    home = router.probabilities(vectors).argmax(axis=1)
    p = router.probabilities(queries)
    order = np.argsort(-p, axis=1, kind="stable")
    ordered = np.take_along_axis(p, order, axis=1)
    before = np.zeros_like(p)
    np.put_along_axis(before, order, np.cumsum(ordered, axis=1) - ordered, axis=1)
    needed = []
    for start in range(0, len(queries), _AT_ONCE):
        scores = queries[start : start + _AT_ONCE] @ vectors.T
        k = min(K, scores.shape[1])
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        needed.append(np.take_along_axis(before[start : start + _AT_ONCE], home[best], axis=1).ravel())
    needed = np.sort(np.concatenate(needed))
    return float(needed[min(len(needed) - 1, int(np.ceil(coverage * len(needed))))])


def fit(vectors: np.ndarray, parts: int, coverage: float) -> Router:
    """A router from sampled vectors, a quarter of which is kept for the mass to probe."""
    kept = np.arange(len(vectors)) % 4 == 3
    learned = vectors[~kept]
    if parts < 2 or len(learned) < 2 * parts or not kept.any():
        return Router(np.zeros((vectors.shape[1], 1)), np.zeros(1), 0.0)
    graph = neighbour_graph(learned, DEGREE)
    label = balanced_partitions(graph, parts)
    around = np.concatenate((graph, np.arange(len(learned))[:, None]), axis=1)
    goal = np.zeros((len(learned), parts))
    np.add.at(goal, (np.arange(len(learned))[:, None], label[around]), 1 / around.shape[1])
    router = Router(*fit_classifier(learned, goal), 0.0)
    return Router(router.weights, router.offsets, mass_needed(router, vectors[kept], learned, coverage))


# --- points ------------------------------------------------------------------------


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    values = np.frombuffer(b"".join(column.to_pylist()), kind)
    return values.reshape(len(column), -1).astype(np.float64)


def valid_vectors(rows: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, str]:
    """(row, id, vec) of the rows that take part, vectors as packed numbers, and their kind.

    Out are null and empty vectors, zero ones, and those with a null or non-finite
    component; also those not of the most frequent length (of ties the largest).
    """
    kind = "<f8" if "double" in dict(rows.dtypes)[vector_column] else "<f4"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            bad, used = (np.concatenate(([0], np.cumsum(v))) for v in (~np.isfinite(flat), flat != 0))
            good = (bad[ends[1:]] == bad[ends[:-1]]) & (used[ends[1:]] > used[ends[:-1]])
            places = pa.py_buffer((ends * flat.itemsize).astype(np.int32).tobytes())
            vectors = pa.Array.from_buffers(pa.binary(), len(sizes), [None, places, pa.py_buffer(flat.tobytes())])
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), vectors.filter(keep)], ["id", "vec"])

    chosen = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), f"`{vector_column}`")
    found = chosen.mapInArrow(packed, "id long, vec binary")
    found = store(found.select(F.monotonically_increasing_id().alias("row"), "id", "vec"), "vectors")
    size = F.octet_length("vec")
    usual = found.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return found.filter(size == (usual["size"] if usual else 0)), kind


def points_of(vectors: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: point, vec, and its k + 1 smallest members (null id, id, row)."""
    first = Window.partitionBy("vec").orderBy(F.col("id").isNull(), "id", "row")
    few = vectors.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k + 1)
    member = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    points = few.groupBy("vec").agg(F.sort_array(F.collect_list(member)).alias("members"))
    return store(points.select(F.col("members")[0]["row"].alias("point"), "vec", "members"), "points")


def fit_router(points: DataFrame, kind: str, parts: int | None, coverage: float, sample: int) -> Router:
    """The sample is all points whose hash is below a bound, `sample` on average at most."""
    n = points.count()
    if parts is None:
        parts = int(min(MOST_PARTITIONS, np.ceil(np.sqrt(n) * PARTITION_SHARE)))
    scale = 2**31
    chosen = F.pmod(F.xxhash64("vec"), F.lit(scale)) < int(scale * min(1.0, sample / max(n, 1)))

    def fitted(rows: pa.Table) -> pa.Table:
        vectors = _matrix(pa.array(sorted(rows.column("vec").to_pylist())), kind)
        router = fit(vectors, parts, coverage)
        values = [router.weights.tobytes(), router.offsets.tobytes(), router.mass]
        return pa.table({"weights": values[:1], "offsets": values[1:2], "mass": values[2:]})

    models = points.filter(chosen).select("vec", F.lit(0).alias("all")).groupBy("all").applyInArrow(
        fitted, "weights binary, offsets binary, mass double"
    )
    model = models.first()
    if model is None:
        return Router(np.zeros((0, 1)), np.zeros(1), 0.0)
    offsets = np.frombuffer(model["offsets"])
    return Router(np.frombuffer(model["weights"]).reshape(-1, len(offsets)), offsets, model["mass"])


# --- searching -----------------------------------------------------------------------


def rerank(points: pa.Table, queries: pa.Table, kind: str, most: int) -> pa.Table:
    """The `most` best points of a block for each query of a block, by inner products in
    double precision; of ties those whose first member has the smallest id."""
    columns: list[list] = [[], [], []]
    if len(points) and len(queries):
        vectors, asked = _matrix(points.column("vec"), kind), _matrix(queries.column("vec"), kind)
        order = np.argsort(points.column("first").to_numpy(), kind="stable")
        vectors, numbers = vectors[order], points.column("point").to_numpy()[order]
        # Some more than asked for: a product's last bit depends on how it is blocked.
        width = min(len(vectors), most + 4)
        for start in range(0, len(asked), _AT_ONCE):
            some = asked[start : start + _AT_ONCE]
            best = np.sort(np.argpartition(-(some @ vectors.T), width - 1, axis=1)[:, :width], axis=1)
            scores = np.einsum("ijk,ik->ij", vectors[best], some)
            top = np.argsort(-scores, axis=1, kind="stable")[:, :most]
            columns[0].append(np.repeat(queries.column("point").to_numpy()[start : start + len(some)], top.shape[1]))
            columns[1].append(numbers[np.take_along_axis(best, top, axis=1)].ravel())
            columns[2].append(np.take_along_axis(scores, top, axis=1).ravel())
    kinds = (pa.int64(), pa.int64(), pa.float64())
    arrays = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, kinds)]
    return pa.Table.from_arrays(arrays, ["query", "point", "score"])


def _dealt(counts: dict[int, int], block: int) -> Column:
    """For each partition, over how many blocks its rows are dealt. At most `MOST_PARTITIONS` numbers."""
    blocks = [max(1, -(-counts.get(p, 0) // block)) for p in range(max(counts, default=0) + 1)]
    return F.get(F.array(*map(F.lit, blocks)), F.col("part"))


def nearest(
    rows: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = K,
    parts: int | None = None,
    coverage: float = COVERAGE,
    sample: int = SAMPLE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the `k` nearest found for each query row.

    `is_query` is a condition on the column `id`. Candidates are all rows but the query's
    own; rows that repeat an id or a vector are candidates of their own. Nearest first,
    ties to the smaller id, a null id last. See `valid_vectors` for the rows that take no
    part. With fewer than `k` other rows all are returned. An empty table gives no rows.
    Other columns are not read.
    """
    spark = rows.sparkSession
    vectors, kind = valid_vectors(rows, id_column, vector_column)
    points = points_of(vectors, k)
    router = fit_router(points, kind, parts, coverage, sample)
    shared = spark.sparkContext.broadcast(router)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            p = shared.value.probabilities(_matrix(batch.column(1), kind))
            part = pa.array(p.argmax(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, part], ["point", "vec", "first", "part"])

    first = F.coalesce(F.col("members")[0]["id"], F.lit(2**63 - 1))
    indexed = points.select("point", "vec", first.alias("first")).mapInArrow(
        home, "point long, vec binary, first long, part int"
    )
    indexed = store(indexed, "index")
    sizes = {r["part"]: r["n"] for r in indexed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = spark.sparkContext.broadcast(np.array([sizes.get(p, 0) for p in range(len(router.offsets))], np.int64))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            p = shared.value.probabilities(_matrix(batch.column(1), kind))
            order = np.argsort(-p, axis=1, kind="stable")
            p = np.take_along_axis(p, order, axis=1)
            n = held.value[order]
            # Until the mass is reached and enough points are there to fill an answer.
            probed = (np.cumsum(p, axis=1) - p <= shared.value.mass) | (np.cumsum(n, axis=1) - n < k + 1)
            at = np.nonzero(probed & (n > 0))
            few = [column.take(pa.array(at[0])) for column in batch.columns]
            part = pa.array(order[at].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*few, part], ["point", "vec", "part"])

    asking = vectors.filter(is_query)
    asked = store(points.join(asking.select("vec").distinct(), "vec", "left_semi").select("point", "vec"), "queries")
    routed = store(asked.mapInArrow(route, "point long, vec binary, part int"), "routed")
    probes = {r["part"]: r["n"] for r in routed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}

    # A block of points meets a block of queries of its partition in one group.
    point_blocks, query_blocks = _dealt(sizes, POINT_BLOCK), _dealt(probes, QUERY_BLOCK)
    own = F.pmod(F.xxhash64("point"), F.lit(2**31))
    to = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1))
    left = indexed.withColumn("block", own % point_blocks).withColumn("chunk", to(query_blocks))
    right = routed.withColumn("chunk", own % query_blocks).withColumn("block", to(point_blocks))
    keys = ["part", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda points, queries: rerank(points, queries, kind, k + 1), "query long, point long, score double"
    )
    members = points.select("point", "members", F.col("members")[0].alias("head"))
    named = store(found, "reranked").join(members, "point")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "head")
    few = named.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k + 1)
    single = few.select("query", "score", F.explode("members").alias("member"))
    answer = F.struct((-F.col("score")).alias("order"), "member", "score")
    answers = single.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(answer)), 1, k + 1).alias("answers"))
    answers = store(answers.join(asked.withColumnRenamed("point", "query"), "query").select("vec", "answers"), "answers")

    # Copies of one query vector share an answer, each without its own row.
    each = join_dimension(asking, answers, "vec", "inner", spread_by=["row"])
    own_row = F.col("row")
    others = F.slice(F.filter("answers", lambda a: a["member"]["row"] != own_row), 1, k)
    return each.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "a")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("a.member.id").alias("vec_id"), F.col("a.score").alias("score")
    )


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
