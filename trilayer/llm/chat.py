"""Chat logs that hold every stage of a growing conversation: keep the full ones, render them.

A turn's hash covers its place, role and text; the sum of the hashes so far stands for
the conversation's prefix. A conversation whose total is the prefix of a longer one is a
snapshot of it and goes; of equal conversations the smallest conv_id stays. Prefix sums
are taken in blocks of turns and then over blocks, so a conversation of any length is
spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilayer.llm.common import store, table

#: Turn numbers of a block, and turns of a rendered segment.
BLOCK_TURNS, SEGMENT_TURNS = 1024, 1024
_SUMS = ["s1", "s2", "s3", "s4"]
_KEY = ["place", *_SUMS]


def _content(role: str = "role", text: str = "text") -> Column:
    joined = F.concat(F.coalesce(role, F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit("")))
    return F.sha2(F.encode(joined, "UTF-8"), 256)


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, turn, content, place (1, 2, ...), n_turns and the prefix sums of every turn."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", _content().alias("content"))
    rows = rows.distinct().withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK_TURNS))
    in_block = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "content")
    sizes = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("size"))
    over_blocks = Window.partitionBy("conv_id").orderBy("block")
    earlier = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "conv_id", "block",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    placed = rows.withColumn("at", F.row_number().over(in_block)).join(sizes, ["conv_id", "block"])
    placed = placed.withColumn("place", F.col("before") + F.col("at")).drop("before", "at")
    low, high = 0xFFFFFFFF, 32
    hashes = [F.xxhash64("place", "content"), F.xxhash64("content", "place")]
    parts = [f(h) for h in hashes for f in (lambda h: h.bitwiseAND(low), lambda h: F.shiftrightunsigned(h, high))]
    placed = placed.select("*", *[p.alias(f"h{i}") for i, p in enumerate(parts, 1)])
    totals = placed.groupBy("conv_id", "block").agg(*[F.sum(f"h{i}").alias(f"t{i}") for i in range(1, 5)])
    totals = totals.select(
        "conv_id", "block",
        *[F.coalesce(F.sum(f"t{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in range(1, 5)],
    )
    running = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumns({f"r{i}": F.sum(f"h{i}").over(running) for i in range(1, 5)})
    return placed.join(totals, ["conv_id", "block"]).select(
        "conv_id", "turn", "content", "place", "n_turns",
        *[(F.col(f"r{i}") + F.col(f"b{i}")).alias(f"s{i}") for i in range(1, 5)],
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns and copies of the conversations that prefix no longer one."""
    whole = F.col("place") == F.col("n_turns")
    ends = prefixes.filter(whole).groupBy(*_KEY)
    ends = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = prefixes.filter(~whole).select(*_KEY).distinct()
    kept = ends.join(inner, _KEY, "left_anti")
    return kept.select("conv_id", F.col("place").alias("n_turns"), "copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """Rendered maximal conversations: conv_id, segment, n_turns, copies and text.

    A turn is rendered as its role in a mark, its text and an end mark. Segments of
    `SEGMENT_TURNS` turns keep rows bounded. Null roles and texts are empty. Rows that
    repeat a turn's number, role and text count once; other rows of one turn number
    follow each other by content. Rows without a conv_id are left out. Other columns
    are not read.
    """
    prefixes = store(turn_prefixes(turns), "turn-prefixes")
    kept = maximal_conversations(prefixes)
    places = prefixes.select("conv_id", "turn", "content", "place").join(kept, "conv_id")
    rendered = F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n")
    )
    texts = turns.select("conv_id", "turn", _content().alias("content"), rendered.alias("rendered"))
    same = (
        (F.col("t.conv_id") == F.col("p.conv_id"))
        & F.col("t.turn").eqNullSafe(F.col("p.turn"))
        & (F.col("t.content") == F.col("p.content"))
    )
    joined = texts.alias("t").join(places.alias("p"), same)
    segment = F.floor((F.col("place") - 1) / SEGMENT_TURNS)
    grouped = joined.groupBy(F.col("p.conv_id").alias("conv_id"), segment.alias("segment"))
    in_order = F.array_sort(F.collect_set(F.struct("place", "rendered")))
    return grouped.agg(
        F.first("n_turns").alias("n_turns"),
        F.first("copies").alias("copies"),
        F.array_join(F.transform(in_order, lambda t: t["rendered"]), "").alias("text"),
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


OP8_SQL = """
with turns as (
  select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    sha256(coalesce(role, '') || chr(31) || coalesce(text, '')) as content
  from conversations where conv_id is not null
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, content) as place,
    count(*) over (partition by conv_id) as n_turns
  from turns
), prefixes as (
  select *, string_agg(content, ',') over (partition by conv_id order by place) as prefix from placed
), ends as (
  select prefix, n_turns, min(conv_id) as conv_id, count(*) as copies
  from prefixes where place = n_turns group by all
), kept as (
  select * from ends where prefix not in (select prefix from prefixes where place < n_turns)
)
select conv_id, (place - 1) // 1024 as segment, any_value(k.n_turns) as n_turns,
  any_value(copies) as copies,
  string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' order by place) as text
from placed join kept k using (conv_id)
group by all
"""
