"""Nearest neighbours: recall against all pairs, the order of answers, and unclean vectors."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import workers_import_the_library  # noqa: F401
from pyspark.sql import functions as F

from trilayer.llm import neighbours
from trilayer.llm.neighbours import balanced_partitions, nearest, neighbour_graph
from trilayer.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>, part int, score string, row string"


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "s", "r") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, ROWS)


def answers(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r.query_id].append(r)
    for rows in found.values():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        order = [(-r.score, r.vec_id is None, r.vec_id or 0) for r in rows]
        assert order == sorted(order)
    return found


def exact(ids, vectors, at, k=20):
    scores = np.einsum("ij,j->i", vectors, vectors[at])
    scores[at] = -np.inf
    return scores, [ids[i] for i in np.lexsort((ids, -scores))[: min(k, len(ids) - 1)]]


def recall(found, ids, vectors, queries):
    shares = []
    for at in queries:
        scores, best = exact(ids, vectors, at)
        rows = found[ids[at]]
        by_id = dict(zip(ids, scores))
        assert len(rows) == len(best) == len({r.vec_id for r in rows})
        assert all(r.score == pytest.approx(by_id[r.vec_id], abs=1e-13) for r in rows)
        shares.append(len(set(best) & {r.vec_id for r in rows}) / len(best))
    return np.mean(shares)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whole_query(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    found = answers(QUERIES["op13_nearest_neighbours"](spark, f"/root/testdata/{sf}"))
    queries = [i for i, v in enumerate(ids) if v % 20 == 0]
    assert set(found) == {ids[i] for i in queries}
    assert recall(found, ids, vectors, queries) >= 0.9


def test_clustered_vectors_with_hot_copies(spark, monkeypatch):
    """Few partitions hold the neighbours; a third of the rows are copies of one vector."""
    random = np.random.default_rng(2)
    centers = random.standard_normal((40, 16))
    vectors = (centers[random.integers(0, 40, 4000)] + 0.15 * random.standard_normal((4000, 16))).astype(np.float32)
    vectors[:1333] = vectors[0]
    ids = random.permutation(4000).tolist()
    monkeypatch.setattr(neighbours, "POINT_BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 10)
    found = answers(nearest(frame(spark, ids, vectors), F.col("id") % 20 == 0))
    queries = [i for i, v in enumerate(ids) if v % 20 == 0]
    assert recall(found, ids, vectors.astype(np.float64), queries) >= 0.95
    copies = sorted(ids[:1333])
    asked = next(ids[i] for i in queries if i < 1333)
    best = [v for v in copies if v != asked]
    top = vectors.astype(float) @ vectors[0].astype(float)
    if (top > top[0]).sum() == 0:
        assert [r.vec_id for r in found[asked]] == best[:20]


def test_probing_is_less_than_all(spark):
    """On clustered vectors the classifier leaves most partitions out."""
    random = np.random.default_rng(3)
    centers = 4 * random.standard_normal((64, 8))
    vectors = centers[random.integers(0, 64, 6000)] + 0.3 * random.standard_normal((6000, 8))
    router = neighbours.fit(vectors, 32, 0.97)
    p = -np.sort(-router.probabilities(vectors), axis=1)
    probes = ((np.cumsum(p, axis=1) - p) <= router.mass).sum(axis=1)
    assert probes.mean() < 16


def test_partitions_are_balanced():
    random = np.random.default_rng(4)
    vectors = random.standard_normal((1000, 8))
    graph = neighbour_graph(vectors, 10)
    label = balanced_partitions(graph, 7)
    sizes = np.bincount(label, minlength=7)
    assert sizes.min() >= 120 and sizes.max() <= 165
    kept = (label[graph] == label[:, None]).mean()
    assert kept > 2 * (1 / 7)


def test_unclean_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [1, 0], None, [0, 0], [nan, 1], [inf, 1], [None, 1], [], [1, 2, 3], [-1, 0], [0.5, 0.5], [1, 0], [2, 0]]
    ids = [20, 20, 40, 60, 80, 100, 120, 140, 160, 180, 3, 5, None]
    got = nearest(frame(spark, ids, vectors), F.col("id") % 20 == 0).collect()
    # Both rows of id 20 are asked, and each has the other among its candidates.
    assert sorted((r.query_id, r["rank"]) for r in got) == sorted([(q, k) for q in (20, 20, 180) for k in range(1, 6)])
    found = answers(nearest(frame(spark, ids, vectors), F.col("id") == 180))
    assert [(r.vec_id, r.score) for r in found[180]] == [(3, -0.5), (5, -1.0), (20, -1.0), (20, -1.0), (None, -2.0)]


def test_repeated_ids(spark):
    df = frame(spark, [20, 20, 7], [[1, 0], [0, 1], [1, 1]])
    got = sorted((r["rank"], r.vec_id, r.score) for r in nearest(df, F.col("id") == 20).collect())
    assert got == [(1, 7, 1.0), (1, 7, 1.0), (2, 20, 0.0), (2, 20, 0.0)]


def test_few_or_no_rows(spark):
    assert nearest(frame(spark, [], []), F.col("id") % 20 == 0).count() == 0
    assert nearest(frame(spark, [20], [[1.0, 2.0]]), F.col("id") % 20 == 0).count() == 0
    assert nearest(frame(spark, [1, 2], [[1.0], [2.0]]), F.col("id") % 20 == 0).count() == 0
    two = nearest(frame(spark, [20, 1], [[1.0, 2.0], [3.0, 4.0]]), F.col("id") % 20 == 0).collect()
    assert [tuple(r) for r in two] == [(20, 1, 1, 11.0)]
    doubles = spark.createDataFrame([(20, [1.0, 1e-30]), (1, [1.0, 1e30])], "vec_id long, embedding array<double>")
    assert nearest(doubles, F.col("id") % 20 == 0).first().score == 2.0
