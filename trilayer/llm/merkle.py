"""A Merkle manifest of a table, its levels kept as concatenated strings.

The leaves of a group (a language) are numbered by document. Each aligned block of
`ARITY ** LEVELS` nodes keeps every level of its subtree as one hex string. A parent is the
hash of a fixed-width substring of the level below; the siblings of a node are what stands
left and right of it in the substring of its run. The blocks' roots are the nodes of the
next tier, until each group has one root; the groups' roots, in order of the groups, are
numbered and hashed by the same steps. The way up of a block is then handed down tier by
tier, so a leaf's proof is its segments within its block followed by those of the block.

Blocks have a fixed size, so neither a large group nor a large table meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm.common import store, table
from trilayer.operators.joins import join_dimension
from trilayer.operators.ordering import number_rows

ARITY, LEVELS = 8, 3
BLOCK = ARITY**LEVELS
#: Characters of a node in a level, and of a run of siblings.
WIDTH = 64
RUN = WIDTH * ARITY
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:binary,right:binary>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _hash(value: Column) -> Column:
    """Hex digest as bytes: their substrings need no search for the start of a character."""
    return F.sha2(value, 256).cast("binary")


def leaf_of(values: Sequence[Column]) -> Column:
    """Hash of the values, each with its length; null differs from the empty text."""
    texts = [value.cast("string") for value in values]
    fields = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return _hash(F.concat(*fields))


def _parents(level: Column) -> Column:
    last = F.ceil(F.octet_length(level) / RUN).cast("int") - 1
    runs = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)
    )
    return F.array_join(runs, "").cast("binary")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """The nodes (group, at, hash and others) of one tier by aligned block, with its levels.

    A block alone in its group stops at its root; others rise through all levels, so the
    last, short block of a group stays in step with its neighbours.
    """
    block = F.floor(F.col("at") / BLOCK)
    members = F.array_sort(F.collect_list(F.struct("at", *[c for c in nodes.columns if c not in ("group", "at")])))
    blocks = nodes.groupBy("group", block.alias("block")).agg(members.alias("members"))
    lone = (F.col("block") == 0) & (F.size("members") < BLOCK)
    level = F.array_join(F.transform("members", lambda m: m["hash"].cast("string")), "").cast("binary")
    # Each level is read by several expressions: written first, so that none is hashed twice.
    blocks = store(blocks.select("*", lone.alias("lone"), level.alias("level0")), name)
    for depth in range(LEVELS):
        below = F.col(f"level{depth}")
        done = F.col("lone") & (F.octet_length(below) <= WIDTH)
        blocks = blocks.withColumn(f"level{depth + 1}", F.when(~done, _parents(below)))
    root = F.coalesce(*[F.col(f"level{depth}") for depth in range(LEVELS, -1, -1)])
    return store(blocks.withColumn("root", root).drop("lone"), name)


def _tiers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of every tier, the leaves' first; in the last one each group has one block."""
    tiers = [_blocks(nodes, name)]
    while tiers[-1].agg(F.max("block")).first()[0]:
        below = tiers[-1].select("group", F.col("block").alias("at"), F.col("root").alias("hash"))
        tiers.append(_blocks(below, name))
    return tiers


def _siblings(at: Column) -> Column:
    """What stands left and right of a node and of its ancestors, in their block."""
    segments = []
    for depth in range(LEVELS):
        place = F.shiftright((at % BLOCK).cast("int"), 3 * depth)
        first, own = F.floor(place / ARITY).cast("int") * RUN, place * WIDTH
        level = F.col(f"level{depth}")
        pair = F.struct(
            F.substring(level, first + 1, own - first).alias("left"),
            F.substring(level, own + WIDTH + 1, first + RUN - own - WIDTH).alias("right"),
        )
        segments.append(F.when(F.col(f"level{depth + 1}").isNotNull(), pair))
    return F.array_compact(F.array(*segments))


def _descend(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves' members with their whole way `up`; `tops`: group, up and columns to carry.

    Joins meet one row per block, so no group is hot.
    """
    carried = [c for c in tops.columns if c not in ("group", "up")]
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for number, blocks in reversed(list(enumerate(tiers))):
        joined = blocks.drop("root").join(above, ["group", "block"])
        ways = F.transform(
            "members", lambda m: F.struct(m.alias("m"), F.concat(_siblings(m["at"]), F.col("up")).alias("up"))
        )
        rows = joined.select("group", *carried, F.inline(ways))
        if not number:
            return rows.select("group", *carried, "m.*", "up")
        above = store(rows.select("group", F.col("m.at").alias("block"), "up", *carried), "ways")
    raise ValueError("no tier")


def manifest(docs: DataFrame, forged: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, siblings, forged.

    `siblings` holds, level by level up to the root, the concatenated digests left and right
    of the node. `forged`, another hash for some rows, is carried along (else null).

    Leaves ascend by doc_id in each lang; null ids come first and rows of one id in order of
    their digests, so the root does not depend on how rows are stored. Null is a lang of its
    own, the first. A null field differs from an empty one. Repeated rows are leaves of their
    own. An empty table gives no rows. Columns beyond `FIELDS` are not read.
    """
    fields = docs.select(*[F.col(f"`{c}`") for c in FIELDS])
    leaves = fields.select(
        "doc_id", "lang", leaf_of([F.col(c) for c in FIELDS]).alias("hash"),
        (F.lit(None).cast("binary") if forged is None else forged).alias("forged"),
    )
    placed = number_rows(store(leaves, "leaves"), ["lang", "doc_id", "hash"], "place")
    placed = placed.withColumn("group", F.struct("lang"))
    starts = store(placed.groupBy("group").agg(F.min("place").alias("start")), "group-starts")
    nodes = join_dimension(placed, starts, "group", "inner", spread_by=["place"])
    nodes = nodes.select("group", (F.col("place") - F.col("start")).alias("at"), "hash", "doc_id", "forged")
    tiers = _tiers(nodes, "blocks")

    subroots = store(tiers[-1].select("group.lang", F.col("root").alias("hash")), "subroots")
    groups = number_rows(subroots, ["lang"], "at").withColumn("group", F.lit(0))
    upper = _tiers(groups, "upper-blocks")
    top = upper[-1].select("group", F.array().cast(PATH).alias("up"), "root")
    ways = _descend(upper, top).select(F.struct("lang").alias("group"), F.col("hash").alias("subroot"), "root", "up")
    leaf, *others = (F.col(c).cast("string").alias(n) for c, n in (("hash", "leaf"), ("subroot", "subroot"), ("root", "root"), ("forged", "forged")))
    return _descend(tiers, store(ways, "ways")).select("doc_id", leaf, *others, F.col("up").alias("siblings"))


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    step = lambda acc, s: _hash(F.concat(s["left"], acc, s["right"]))
    return F.aggregate(siblings, leaf.cast("binary"), step).cast("string")


def proof_digest(siblings: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"]).cast("string")), ""), 256)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and how it judges rows of which a third has had its text lower-cased."""
    fields = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = manifest(table(spark, sf_dir, "documents"), F.when(third, leaf_of(fields)))
    folded = fold(F.coalesce("forged", "leaf"), F.col("siblings"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("siblings")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )
