"""Near-duplicates by an LSH forest of MinHash labels.

A document is the set of its word shingles; documents with one set are one node. Each
of `TREES` orders the nodes by a label of MinHash values of its own. Nodes that share
the first `BASE` values of a label are a region. A small region compares all its nodes.
A crowded one is descended: its nodes are compared where their labels agree further, and
the deeper the more crowded it is; there each node is compared with its neighbours in
label order, those of the longest common prefix, and with the region's center, the node
its most crowded branches lead to. Candidates are confirmed on the full sets, and linked
nodes form components.

A crowded region may still hold links between components. Where it has several, its nodes
are compared exactly: two sets of the linking similarity share a shingle among their rarest
few, so only nodes that do and are of different components are confirmed. A region that
is one component, as that of thousands of copies, needs none of it.

Two sets of the linking similarity share `BASE` values in at least one of the trees with a
probability of 1 - 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilayer.llm.common import FILTER_BITS, ROW, bit_filter, bits_at, located, slices, store, table, without_rows
from trilayer.llm.words import hash_words, mix, word_hashes, word_lists

WORDS = 5
PERCENT = 85
TREES, BASE = 32, 6
#: Label lengths a crowded region is descended to.
DEPTHS = (8, 12, 16)
#: Nodes of a region that are compared all with all, and neighbours compared elsewhere.
CROWDED, NEIGHBOURS = 32, 2
#: Candidates whose labels agree in fewer values are not confirmed: six standard errors
#: below the linking similarity.
LEAST_AGREEING = 0.70
VALUES = TREES * BASE
NO_ID = -(2**63)
_ROW_KIND = "struct<file:bigint,index:bigint>"
_SEEDS = np.random.default_rng(20).integers(0, 2**32, (2, VALUES), dtype=np.uint64).astype(np.uint32)
_SEEDS[0] |= np.uint32(1)


def shingles(text: str | None, memory, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a whole text.

    Words stand between ASCII white space, A-Z lower-cased. Fewer words than a shingle
    has are one shingle; a text without words has none.
    """
    h = np.concatenate([np.zeros(0, np.uint64), *(hash_words(some, memory) for some in word_lists(text))])
    size = min(words, len(h))
    if not size:
        return h
    count = len(h) - size + 1
    s = mix(h[:count] + np.uint64(size))
    for j in range(1, size):
        s = mix(s ^ h[j : count + j])
    return np.unique(s)


def node_of(s: np.ndarray) -> int:
    """A 64-bit name of a shingle set."""
    return int(mix(mix(s).sum(keepdims=True) ^ np.uint64(len(s))).view(np.int64)[0])


def minhashes(s: np.ndarray) -> np.ndarray:
    low = np.full(VALUES, 2**32 - 1, np.uint32)
    x = (mix(s) >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), 4096):
        part = x[start : start + 4096, None] ^ _SEEDS[1]
        part *= _SEEDS[0]
        part ^= part >> np.uint32(15)
        np.minimum(low, part.min(axis=0), out=low)
    return low


def _sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, row, n_shingles, node (hash of the set), the MinHash values and their low bytes."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = word_hashes()
        for batch in slices(batches, 256):
            sets = [shingles(t.as_py(), memory, words) for t in batch.column(1)]
            nodes = [node_of(s) for s in sets]
            values = [minhashes(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array([None if v is None else v.tobytes() for v in values], pa.binary()),
                    pa.array([None if v is None else v.astype(np.uint8).tobytes() for v in values], pa.binary()),
                ],
                ["doc_id", ROW, "n_shingles", "node", "minhash", "brief"],
            )

    kinds = f"doc_id long, {ROW} {_ROW_KIND}, n_shingles long, node long, minhash binary, brief binary"
    return docs.select("doc_id", "text", ROW).mapInArrow(sketch, kinds)


def _labels(nodes: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """A row per node and tree: keys of its label's first values, at each depth. With
    `regions`, their keys, mostly rows of those: the rest of the tree's rows goes in the task."""
    known = None
    if regions is not None:
        places = regions.select(F.pmod(F.col(regions.columns[0]), F.lit(FILTER_BITS)).alias("at"))
        known = nodes.sparkSession.sparkContext.broadcast(bit_filter(places))
    names = ["tree", "node", "n", *[f"k{d}" for d in (BASE, *DEPTHS)]]

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, VALUES)
            node, n = (batch.column(i).to_numpy() for i in (0, 1))
            for tree in range(TREES):
                key = np.full(len(node), tree + 1, np.uint64)
                columns = []
                for depth in range(DEPTHS[-1]):
                    key = mix(key ^ values[:, (tree * BASE + depth) % VALUES])
                    if depth + 1 in (BASE, *DEPTHS):
                        columns.append(pa.array(key.view(np.int64)))
                arrays = [pa.array(np.full(len(node), tree, np.int32)), pa.array(node), pa.array(n), *columns]
                rows = pa.RecordBatch.from_arrays(arrays, names)
                if known is not None:
                    at = columns[0].to_numpy() & np.int64(FILTER_BITS - 1)
                    rows = rows.filter(pa.array(bits_at(known.value, at)))
                yield rows

    kinds = "tree int, node long, n long, " + ", ".join(f"{k} long" for k in names[3:])
    return nodes.select("node", "n", "minhash").mapInArrow(labels, kinds)


def _sized(rows: DataFrame, key: str) -> DataFrame:
    """Rows of the keys that several rows have, with their number as `size`."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows.drop("size").join(sizes, key)


def _similar_size(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b) of nodes, a < b, and the rows of crowded regions."""
    base = f"k{BASE}"
    sizes = store(_labels(nodes).groupBy(base).agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "regions")
    # The filter is part of the labelling: a second Python step would be a second worker a task.
    rows = store(_labels(nodes, sizes.select(base)).join(sizes, base), "region-rows")

    small = rows.filter(F.col("size") <= CROWDED)
    members = small.groupBy(base).agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("m"))
    later = F.transform(
        "m",
        lambda x, i: F.transform(
            F.filter(F.slice(F.col("m"), i + 2, CROWDED), lambda y: _similar_size(x["n"], y["n"])),
            lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")),
        ),
    )
    parts = [members.select(F.explode(F.flatten(later)).alias("p")).select("p.a", "p.b")]

    crowded = rows.filter(F.col("size") > CROWDED)
    deep = [f"k{d}" for d in DEPTHS]
    if crowded.limit(1).count():
        # How crowded a node's branches are at each depth says how near the center it is.
        level = crowded
        for key in deep:
            counts = crowded.groupBy(key).agg(F.count(F.lit(1)).alias(f"c_{key}"))
            level = level.join(counts, key)
        level = store(level, "crowded-rows")
        rank = F.struct(*[f"c_{k}" for k in reversed(deep)], F.xxhash64("node").alias("h"), "node", "n")
        centers = level.groupBy(base).agg(F.max(rank).alias("c"))
        star = level.join(centers, base).select(
            F.col("node").alias("x"), F.col("c.node").alias("y"), "n", F.col("c.n").alias("m")
        )
        parts.append(_ordered(star))
        # Label order within blocks of a region, dealt out by the first depth at which
        # the branch is small enough, else by hash.
        block = F.when(F.col("c_k8") <= 4096, F.xxhash64("k8"))
        for key in deep[1:]:
            block = block.when(F.col(f"c_{key}") <= 4096, F.xxhash64(F.lit(key), key))
        spread = F.pmod(F.xxhash64("node"), F.ceil(F.col(f"c_{deep[-1]}") / 4096))
        block = block.otherwise(F.xxhash64(deep[-1], spread))
        order = Window.partitionBy(base, block).orderBy(*deep, F.xxhash64("node"))
        near = level.select(
            "node", "n",
            *[
                F.struct(F.lead("node", d).over(order).alias("node"), F.lead("n", d).over(order).alias("n")).alias(f"l{d}")
                for d in range(1, NEIGHBOURS + 1)
            ],
        )
        for d in range(1, NEIGHBOURS + 1):
            pair = near.select(F.col("node").alias("x"), F.col(f"l{d}.node").alias("y"), "n", F.col(f"l{d}.n").alias("m"))
            parts.append(_ordered(pair))
    pairs = parts[0]
    for part in parts[1:]:
        pairs = pairs.union(part)
    return pairs.distinct(), crowded.select(F.col(base).alias("region"), "node")


def _ordered(pairs: DataFrame) -> DataFrame:
    good = F.col("y").isNotNull() & (F.col("x") != F.col("y")) & _similar_size(F.col("n"), F.col("m"))
    return pairs.filter(good).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose MinHash values agree often enough to be worth confirming."""
    values = nodes.select("node", "brief")
    left = values.select(F.col("node").alias("a"), F.col("brief").alias("va"))
    right = values.select(F.col("node").alias("b"), F.col("brief").alias("vb"))

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, VALUES) for i in (2, 3)
            )
            keep = (x == y).mean(axis=1) >= LEAST_AGREEING
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(agree, "a long, b long")


def _sets(docs: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """Full shingle sets of the chosen nodes, each from the texts of its first document.

    The texts that may be wanted are found within the task, and only sets are shuffled.
    """
    key = F.coalesce("doc_id", F.lit(NO_ID)).alias("key")
    ids = chosen.select(key).distinct()
    place = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS)).alias("at")
    known = docs.sparkSession.sparkContext.broadcast(bit_filter(ids.select(place)))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = word_hashes()
        for batch in slices(batches, 256):
            batch = batch.filter(pa.array(bits_at(known.value, batch.column(1).to_numpy())))
            values = [shingles(t.as_py(), memory, words) for t in batch.column(2)]
            nodes = pa.array([node_of(s) for s in values], pa.int64())
            lists = pa.array([s.view(np.int64) for s in values], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), nodes, lists], ["key", "node", "shingles"])

    texts = docs.select(key, "text").select("key", place, "text")
    found = texts.mapInArrow(sets, "key long, node long, shingles array<long>").join(ids, "key", "left_semi")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    linked = both * 100 >= (F.size("sa") + F.size("sb") - both) * PERCENT
    return pairs.join(left, "a").join(right, "b").filter(linked).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, root for every node with a link; links are drawn to smallest neighbours until
    every component is a star (alternating large and small stars)."""
    edges = store(links.select("a", "b"), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), F.col("b"))
        large = large.filter("a <> b").distinct()
        smaller = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(smaller, "b")
        small = joined.select(F.col("m").alias("a"), "b").union(joined.select(F.col("m").alias("a"), F.col("a").alias("b")))
        edges = store(small.filter("a <> b").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)


#: Counters of the sketch that says how rare a shingle is; it orders shingles, no more.
RARITY = 1 << 20


def least_shared(a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | int:
    """Shingles that sets of these sizes share at least if they are linked."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def _unsettled(crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """node, root of the nodes in crowded regions that hold several components."""
    rooted = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = store(rooted, "rooted-regions")
    several = rooted.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return rooted.join(several, "region").select("node", "root").distinct()


def _rarity(sets: DataFrame) -> np.ndarray:
    """How many sets hold the shingles of each counter; of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(RARITY, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy() & (RARITY - 1), minlength=RARITY)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["slot", "n"])

    counted = sets.select("shingles").mapInArrow(count, "slot long, n long")
    rows = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    rarity = np.zeros(RARITY, np.int64)
    rarity[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return rarity


def _rarest(sets: DataFrame) -> DataFrame:
    """For each set (node, root, shingles) its rarest shingles, with their place in that
    order: token, node, root, n (size), place, and whether the smaller of two linked sets
    could share it first (`first`)."""
    rarity = sets.sparkSession.sparkContext.broadcast(_rarity(sets))
    kinds = "token long, node long, root long, n long, place long, first boolean"

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            parts = []
            for node, root, shingles in zip(*(batch.column(i) for i in range(3))):
                tokens = shingles.values.to_numpy()
                n = len(tokens)
                # The longest prefix is that beside the smallest set that can be linked.
                most = n - least_shared(n, -(-PERCENT * n // 100)) + 1
                order = np.lexsort((tokens, rarity.value[tokens & (RARITY - 1)]))[:most]
                place = np.arange(len(order))
                parts.append((tokens[order], node.as_py(), root.as_py(), n, place, place <= n - least_shared(n, n)))
            columns = [np.concatenate([np.broadcast_to(p[i], len(p[0])) for p in parts]) for i in range(6)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), [k.split()[0] for k in kinds.split(", ")])

    return sets.select("node", "root", "shingles").mapInArrow(rarest, kinds)


def _across(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes in different components that may be linked: all that are, and few more.

    Of two linked sets the smaller one's first shared shingle, rarest first, is among its
    `first` ones and among the larger one's rarest. For each shingle the component with the
    most sets meets the others only, so a shingle of one large component costs no pairs.
    """
    tokens = store(_rarest(sets), "rare-shingles")
    per_root = tokens.groupBy("token", "root").agg(F.count(F.lit(1)).alias("held"))
    main = per_root.groupBy("token").agg(F.max(F.struct("held", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    main = main.filter("roots > 1").select("token", F.col("main.root").alias("main"))
    shared = store(tokens.join(main, "token").withColumn("is_main", F.col("root") == F.col("main")).drop("main"), "shared-shingles")
    small = shared.filter("first").select(*[F.col(c).alias(f"{c}1") for c in ("token", "node", "root", "n", "place", "is_main")])
    large = shared.drop("first")
    least = F.ceil((F.col("n") + F.col("n1")) * PERCENT / F.lit(100 + PERCENT))
    fits = (
        (F.col("token") == F.col("token1"))
        & (F.col("root") != F.col("root1"))
        & (F.struct("n1", "node1") < F.struct("n", "node"))
        & (F.col("place") <= F.col("n") - least)
        & (F.col("place1") <= F.col("n1") - least)
    )
    pairs = small.filter("not is_main1").join(large, fits).unionByName(
        small.filter("is_main1").join(large.filter("not is_main"), fits)
    )
    return pairs.select(F.least("node", "node1").alias("a"), F.greatest("node", "node1").alias("b")).distinct()


def _rooted(nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """node, root of all nodes that a link ties to others."""

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = store(_agreeing(pairs, nodes), "agreeing-pairs")
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        return confirmed(pairs, store(_sets(texts, firsts(ends), words), "sets"))

    def firsts(some: DataFrame) -> DataFrame:
        return nodes.join(some, "node").select("node", F.col("first_doc").alias("doc_id"))

    pairs, crowded = candidates(nodes)
    roots = store(components(checked(store(pairs, "pairs"))), "roots")
    unsettled = store(_unsettled(crowded, roots), "unsettled")
    if not unsettled.limit(1).count():
        return roots
    sets = store(_sets(texts, firsts(unsettled.select("node")), words).join(unsettled, "node"), "unsettled-sets")
    more = checked(store(_across(sets), "pairs-across"))
    # Links between components: nodes stand for their roots.
    of = unsettled.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    to = unsettled.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    between = more.join(of, "a").join(to, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
    further = store(components(between), "further-roots").select(F.col("node").alias("root"), F.col("root").alias("last"))
    every = roots.union(further.join(roots, "root", "left_anti").select("root", "root"))
    return every.join(further, "root", "left").select("node", F.coalesce("last", "root").alias("root"))


def _grouped(docs: DataFrame, words: int) -> DataFrame:
    """The rows of `docs` (doc_id, text and a row) with n_shingles, root (null without
    shingles) and the component's smallest doc_id."""
    texts = docs.select("doc_id", "text")
    sketched = store(_sketch(docs, words).withColumn("empty", F.col("n_shingles") == 0), "sketches")
    nodes = store(
        sketched.filter(~F.col("empty"))
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.first("n_shingles").alias("n"),
            F.first("minhash").alias("minhash"),
            F.first("brief").alias("brief"),
        ),
        "nodes",
    )
    roots = store(_rooted(nodes, texts, words), "all-roots")
    rooted = nodes.join(roots, "node", "left").select("node", "first_doc", F.coalesce("root", "node").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first_doc").alias("component"))
    named = rooted.join(firsts, "root").select("node", "root", "component")
    columns = ["doc_id", ROW, "n_shingles", "root", "component"]
    joined = sketched.filter(~F.col("empty")).join(named, "node")
    alone = sketched.filter("empty").withColumn("component", F.col("doc_id")).withColumn("root", F.lit(None).cast("long"))
    return joined.select(*columns).union(alone.select(*columns))


def near_groups(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents of Jaccard similarity of at least `PERCENT` hundredths are linked.
    component_id is the smallest doc_id reachable by links. Null and empty texts have no
    shingles and no links. A null doc_id has no component of its own: its component_id
    is that of its copies if any has an id, else null, and it is kept only in the latter
    case. Repeated rows are documents with one set. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(None).cast(_ROW_KIND).alias(ROW))
    return _grouped(texts, words).select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of `docs` for each component, all columns: of those with its smallest doc_id
    (a null one only where there is no other) the first as stored. Rows without shingles stay."""
    rows = located(docs)
    texts = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", ROW)
    grouped = store(_grouped(texts, words).filter("root is not null"), "near-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW)
    first = grouped.groupBy("root").agg(F.min(rank).alias("stays"))
    gone = grouped.join(first, "root").filter(F.col(ROW) != F.col(f"stays.{ROW}"))
    return without_rows(rows, gone.select(ROW))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
