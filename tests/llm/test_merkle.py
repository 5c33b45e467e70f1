"""The manifest against a plain recursive version, and rows that are not clean."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from llm_fixtures import empty, messy, workers_import_the_library  # noqa: F401
from pyspark.sql import functions as F

from trilayer.llm import merkle
from trilayer.llm.merkle import fold, manifest, proof_digest
from trilayer.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each leaf what stands left and right of its ancestors."""
    ways, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, range(len(places))):
            run = places[i] // 8 * 8
            way.append((nodes[run : places[i]], nodes[places[i] + 1 : run + 8]))
            places[i] //= 8
        nodes = [h("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row.lang].append(row)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(groups[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        leaves = [leaf(r, r.text) for r in own]
        trees[lang] = (own, leaves, *tree(leaves))
    root, above = tree([trees[lang][2] for lang in langs])
    for lang, up in zip(langs, above):
        own, leaves, subroot, ways = trees[lang]
        for row, mine, way in zip(own, leaves, ways):
            way = way + up
            folded = mine
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                folded = leaf(row, row.text and row.text.translate(LOWER))
            for left, right in way:
                folded = h("".join([*left, folded, *right]))
            proof = h("".join("".join(left + right) for left, right in way))
            yield (row.doc_id, mine, subroot, root, proof, folded, folded == root)


def test_whole_query(spark, sf_dir):
    got = QUERIES["op11_merkle_manifest"](spark, sf_dir).collect()
    wanted = list(brute(spark.read.parquet(f"{sf_dir}/documents.parquet").collect()))
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 511, 512, 513, 520, 4100])
def test_every_depth(spark, n):
    text = F.concat(F.lit("Text "), "id")
    rows = spark.range(n).select(
        (F.col("id") * 7 - 3).alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 11 == 5, "xx").otherwise(F.lit("en")).alias("lang"),
        F.lit(3).cast("long").alias("n_chars"), text.alias("text"),
    )
    got = manifest(rows).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("siblings")).alias("p"), fold(F.col("leaf"), F.col("siblings")).alias("f")
    )
    wanted = {r[:5] for r in brute(rows.collect())}
    assert {tuple(r)[:5] for r in got.collect()} == wanted
    assert got.filter("f <> root").count() == 0


def test_rows_that_are_not_clean(messy, empty):
    got = manifest(messy).collect()
    wanted = list(brute(messy.collect()))
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root) for r in got) == sorted((str(w[0]), *w[1:4]) for w in wanted)
    assert manifest(empty).count() == 0
    # How the rows are stored does not matter.
    turned = manifest(messy.orderBy(F.desc("text")).repartition(5)).first()
    assert turned.root == got[0].root


def test_null_and_empty_differ(spark):
    one = [spark.createDataFrame([(1, None, "en", 0, t)], "doc_id long, source string, lang string, n_chars long, text string") for t in (None, "")]
    roots = [manifest(df).first().root for df in one]
    assert roots[0] != roots[1] and roots == [h("1:1-2:en1:0-"), h("1:1-2:en1:00:")]


def test_blocks_are_aligned():
    assert merkle.BLOCK == merkle.ARITY**merkle.LEVELS and merkle.RUN == merkle.WIDTH * merkle.ARITY
