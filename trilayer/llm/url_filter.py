"""URL rules by a cascade of Bloom filters.

A rule is a key: host and start of the path, such as `example.net/en/`. A url has a
bounded set of keys that could be rules: each suffix of its host with as many labels as
some rule's, by each start of its path that is as long as some rule's. Those of the whole
corpus are the key universe.

Level 0 of a cascade encodes the listed keys. Level 1 encodes the unlisted keys of the
universe that level 0 lets through, level 2 the listed keys that level 1 lets through,
and so on until none is left. A key is listed if the first level that rejects it is
odd. Within the universe this is exact, so no url is joined with the rules.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm.common import store
from trilayer.llm.words import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, ALLOW = "block", "allow"
#: Share of foreign keys that a level lets through.
PASS_RATE = 1 / 64
#: Largest filter that is sent to the executors; more listed keys are split into shards.
MAX_FILTER_BYTES = 64 << 20
MAX_LEVELS = 60


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_keys(host: Column, path: Column, label_counts: Sequence[int], path_lengths: Sequence[int]) -> Column:
    """Keys of a url that could be rules, longest first, of equal length the longer host first.

    No more than the label counts times the path lengths, however long the host. A host of
    fewer labels than asked for stands as it is.
    """
    suffixes = F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in sorted(set(label_counts))]))
    starts = F.array_distinct(F.array(*[F.substring(path, 1, n) for n in sorted(set(path_lengths))]))
    pairs = F.flatten(
        F.transform(
            suffixes,
            lambda h: F.transform(
                starts,
                lambda p: F.struct(
                    (-F.length(h) - F.length(p)).alias("size"),
                    (-F.length(h)).alias("host_size"),
                    F.concat(h, p).alias("key"),
                ),
            ),
        )
    )
    return F.transform(F.array_sort(pairs), lambda pair: pair["key"])


def _hashes(key: Column) -> tuple[Column, Column]:
    return _hash_of(1)(key), _hash_of(2)(key)


def _hash_of(seed: int) -> Callable[[Column], Column]:
    return lambda key: F.xxhash64(F.lit(seed), key)


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    """Bit numbers, one row per key. Every level draws from both hashes anew."""
    a = mix(h1 ^ mix(np.full(1, level + 1, np.uint64)))
    b = mix(h2 ^ mix(a)) | np.uint64(1)
    return (a[:, None] + b[:, None] * np.arange(probes, dtype=np.uint64)) % np.uint64(bits)


class Cascade:
    """Levels of (bits, probes, 64-bit words) for the keys of one shard."""

    def __init__(self, shard: int, shards: int, levels: list[tuple[int, int, np.ndarray]]):
        self.shard, self.shards, self.levels = shard, shards, levels

    def of_shard(self, h1: np.ndarray) -> np.ndarray:
        return mix(h1) % np.uint64(self.shards) == self.shard

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        bits, probes, words = self.levels[level]
        at = _positions(h1, h2, level, bits, probes)
        hit = words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)
        return hit.all(axis=1)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for keys of the universe."""
        listed = np.zeros(len(h1), bool)
        open_at = np.flatnonzero(self.of_shard(h1))
        for level in range(len(self.levels)):
            ok = self.passes(level, h1[open_at], h2[open_at])
            listed[open_at[~ok]] = level % 2 == 1
            open_at = open_at[ok]
        listed[open_at] = len(self.levels) % 2 == 1
        return listed


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def _encode(keys: DataFrame, level: int, bits: int, probes: int) -> np.ndarray:
    """The level's words; tasks merge their own bits before the shuffle."""

    def words_of(batches):
        for batch in batches:
            at = _positions(_unsigned(batch.h1), _unsigned(batch.h2), level, bits, probes).ravel()
            at.sort()
            word, start = np.unique(at >> np.uint64(6), return_index=True)
            if len(word):
                mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start)
                yield pd.DataFrame({"word": word.astype(np.int64), "mask": mask.view(np.int64)})

    rows = (
        keys.select("h1", "h2")
        .mapInPandas(words_of, "word long, mask long")
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toPandas()
    )
    words = np.zeros((bits + 63) // 64, np.uint64)
    words[rows.word.to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return words


def build_cascades(
    universe: DataFrame,
    listed: DataFrame,
    pass_rate: float = PASS_RATE,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> list[Cascade]:
    """Cascades, one per shard, for the keys of `listed` (column key) within `universe`
    (column key). Null keys are left out; repeated ones count once. No listed key: a
    cascade without levels, which contains nothing.

    No level exceeds `max_filter_bytes`: the listed keys are cut into enough shards, and
    each shard's filters are built and sent on their own.
    """
    h1, h2 = _hashes(F.col("key"))
    marked = (
        universe.select("key", F.lit(0).alias("listed"))
        .union(listed.select("key", F.lit(1).alias("listed")))
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("listed").alias("listed"))
    )
    keys = store(marked.select(h1.alias("h1"), h2.alias("h2"), "listed"), "url-keys")
    total = keys.agg(F.sum("listed")).first()[0] or 0
    probes = max(1, round(-math.log2(pass_rate)))
    per_key = probes / math.log(2)
    shards = max(1, math.ceil(total * per_key / 8 / (max_filter_bytes / 2)))
    return [_build_shard(keys, shard, shards, probes, per_key, max_filter_bytes) for shard in range(shards)]


def _build_shard(keys, shard: int, shards: int, probes: int, per_key: float, max_bytes: int) -> Cascade:
    cascade = Cascade(shard, shards, [])

    @F.pandas_udf("boolean")
    def mine(h1: pd.Series) -> pd.Series:
        return pd.Series(cascade.of_shard(_unsigned(h1)))

    keys = keys.filter(mine("h1")) if shards > 1 else keys
    side = [keys.filter("listed = 1"), keys.filter("listed = 0")]
    for level in range(MAX_LEVELS):
        to_encode = side[level % 2]
        n = to_encode.count()
        if not n:
            return cascade
        bits = max(64, math.ceil(n * per_key))
        if bits > 8 * max_bytes:
            raise ValueError(f"level {level} of shard {shard} needs {bits} bits; lower pass_rate")
        cascade.levels.append((bits, probes, _encode(to_encode, level, bits, probes)))
        other = (level + 1) % 2
        side[other] = store(_passing(side[other], cascade, level), "url-level")
    raise RuntimeError("keys whose two 64-bit hashes agree cannot be told apart")


def _passing(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(cascade)

    @F.pandas_udf("boolean")
    def passes(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(shared.value.passes(level, _unsigned(h1), _unsigned(h2)))

    return keys.filter(passes("h1", "h2"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every url.

    `rules` has host, path and verdict. A rule fits its host and all subdomains if the
    url's path starts with the rule's. Where none fits, no key is in the cascade and
    the verdict is `default`. A key listed with both verdicts is allowed. Null urls and
    urls without `://` have an empty host and path. One row per input row; other
    columns of `pages` are not read. Without rules every url gets `default`.
    """
    spark: SparkSession = pages.sparkSession
    rules = rules.select(
        F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))).alias("key"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length(F.coalesce("path", F.lit(""))).alias("path_length"),
        "verdict",
    )
    # Distinct sizes: no more than the longest rule has labels or characters. Null hosts fit nothing.
    sizes = rules.filter(F.col("key").isNotNull()).agg(F.collect_set("labels"), F.collect_set("path_length")).first()
    labels, lengths = (size or [0] for size in sizes)
    url = F.coalesce(F.col(url_column), F.lit(""))
    located = pages.select(
        F.col(id_column).alias(id_column), host_of(url).alias("host"), path_of(url).alias("path")
    )
    keyed = located.withColumn("keys", rule_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = keyed.select(F.explode("keys").alias("key"))
    verdicts = [ALLOW, BLOCK]
    cascades = [build_cascades(universe, rules.filter(F.col("verdict") == v)) for v in verdicts]

    hashed = keyed
    for name, seed in (("h1", 1), ("h2", 2)):
        hashed = hashed.withColumn(name, F.transform("keys", _hash_of(seed)))
    found = []
    for verdict, parts in zip(verdicts, cascades):
        for part in parts:
            name = f"at_{verdict}_{part.shard}"
            hashed = hashed.withColumn(name, _first_listed(spark, part)("h1", "h2"))
            found.append((verdict, name))
    first = F.least(*[F.col(n) for _, n in found], F.lit(2**31 - 1))
    verdict = F.lit(default)
    for value, name in reversed(found):
        verdict = F.when((F.col(name) == first) & F.col(name).isNotNull(), value).otherwise(verdict)
    return hashed.select(
        id_column, "host", "path", F.get("keys", first).alias("rule"), verdict.alias("verdict")
    )


def _first_listed(spark: SparkSession, cascade: Cascade):
    """Index of the first listed key of each row, else null."""
    shared = spark.sparkContext.broadcast(cascade)

    @F.pandas_udf("int")
    def first_listed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        sizes = h1.map(len).to_numpy(np.int64)
        ends = np.cumsum(sizes)
        if not len(ends) or not ends[-1]:
            return pd.Series([None] * len(h1), dtype="object")
        flat = [np.concatenate(list(h)).astype(np.int64).view(np.uint64) for h in (h1, h2)]
        hits = np.flatnonzero(shared.value.contains(*flat))
        row = np.searchsorted(ends, hits, side="right")
        rows, at = np.unique(row, return_index=True)
        out = pd.Series([None] * len(h1), dtype="object")
        out.iloc[rows] = (hits[at] - (ends - sizes)[rows]).tolist()
        return out

    return first_listed


#: The rules of the registered query: host, path, verdict.
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


OP1_SQL = """
with parts as (
  select page_id,
    case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), located as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
), rules(rule_host, rule_path, rule_verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting as (
  select l.*, r.rule_host || r.rule_path as rule, r.rule_verdict,
    row_number() over (partition by page_id, host, path
      order by length(r.rule_host || r.rule_path) desc) as place
  from located l left join rules r
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from fitting where place = 1
"""
