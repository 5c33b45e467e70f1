"""Grouping spelling variants by reduced-alphabet neighbourhoods.

The letters are dealt to a few symbols of about equal weight. Words one edit apart have
reduced words that are equal or one edit apart, so the full one-edit neighbourhood of a
reduced word, small as there are few symbols, holds the reduced forms of all its variants.
Neighbourhoods are joined with the reduced vocabulary and pairs verified on the words as
they are. Each neighbour is generated once, so each pair comes up once from either side.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm.common import FILTER_BITS, bit_filter, bits_at, slices, store, table
from trilayer.llm.words import mix

LETTERS = "A-Za-zÀ-ÿ"
SYMBOLS = 8
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form has at least this many times the occurrences of its variant.
FACTOR = 10
#: Distinct words a task counts before it hands them on; characters it scans at a time.
WORDS_AT_ONCE, SCAN = 200_000, 1 << 20
#: Neighbours a task holds at a time.
NEIGHBOURS_AT_ONCE = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 2**64))


def runs_of(text: str, least: int) -> Iterator[str]:
    """Maximal runs of at least `least` letters, A-Z lower-cased, a stretch of text at a time."""
    text = text.encode("utf-8", "replace").lower().decode("utf-8")
    runs, inside = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[{LETTERS}]*")
    start = 0
    while start < len(text):
        end = inside.match(text, min(start + SCAN, len(text))).end()
        yield from runs.findall(text, start, end)
        start = end


def slipped(doc_id: int | None, run: str, every: int) -> str:
    """The run, short of one letter where its hash says so: a made-up typing error."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip_every: int = 0
) -> DataFrame:
    """word, n over all texts: runs of letters of a least length and number of occurrences.

    `slip_every` lets about one in so many words of a document lose a letter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            arrays = [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())]
            words.clear()
            return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

        words: Counter = Counter()
        for batch in slices(batches, 256):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Shorter runs make no words: a slip only shortens them.
                for run, n in Counter(runs_of(text.as_py() or "", min_length)).items():
                    word = slipped(doc_id, run, slip_every) if slip_every else run
                    if len(word) >= min_length:
                        words[word] += n
                if len(words) >= WORDS_AT_ONCE:
                    yield flush()
        yield flush()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def symbols_of(vocabulary: DataFrame, symbols: int) -> np.ndarray:
    """For each code point the symbol (from 1) it is reduced to: frequent letters are dealt
    out first, each to the symbol with the least weight so far."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter")
    # At most one row per letter of the alphabet.
    weights = {r["letter"]: r["n"] for r in letters.agg(F.count(F.lit(1)).alias("n")).collect() if r["letter"]}
    load, dealt = [0] * symbols, np.ones(256, np.uint64)
    for letter, weight in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        least = load.index(min(load))
        load[least] += weight
        dealt[ord(letter)] = least + 1
    return dealt


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def reduced_keys(reduced: np.ndarray) -> np.ndarray:
    """A 64-bit name of each reduced word; the words (rows) have one length."""
    return mix((reduced * _powers(reduced.shape[1])).sum(axis=1, dtype=np.uint64))


def neighbour_keys(reduced: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names of the words themselves and of all words one edit away, each once per row.

    Yields (row numbers, names), a stretch of positions at a time. Names are sums of
    symbol x power of its place, so those of neighbours follow from prefix sums.
    """
    n, length = reduced.shape
    powers = _powers(length + 1)
    terms = reduced * powers[:length]
    before = np.concatenate((np.zeros((n, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)), axis=1)
    total = before[:, -1:]
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    rows = np.arange(n)
    yield rows, mix(total[:, 0])
    stretch = max(1, NEIGHBOURS_AT_ONCE // (n * (2 * symbols + 1)))
    # The place before the first holds no symbol.
    previous = np.concatenate((np.zeros((n, 1), np.uint64), reduced), axis=1)
    for start in range(0, length + 1, stretch):
        end = min(start + stretch, length + 1)
        # Inserted beside its like, a symbol makes the same word at either side: once.
        new = every * powers[start:end, None]
        inserted = (before[:, start:end] + (total - before[:, start:end]) * np.uint64(_BASE))[:, :, None] + new
        kept = previous[:, start:end, None] != every
        at = np.nonzero(kept)
        yield rows[at[0]], mix(inserted[at])
        end = min(end, length)
        if start >= end:
            continue
        own = reduced[:, start:end]
        at = np.nonzero(own[:, :, None] != every)
        replaced = (total - terms[:, start:end])[:, :, None] + every * powers[start:end, None]
        yield rows[at[0]], mix(replaced[at])
        # Of like symbols in a row, leaving out the first is leaving out any.
        at = np.nonzero(own != previous[:, start:end])
        deleted = before[:, start:end] + (total - before[:, start + 1 : end + 1]) * _BASE_INVERSE
        yield rows[at[0]], mix(deleted[at])


def _by_length(words: list[str], dealt: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of the words, their reduced forms as rows), few enough to derive much from."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        numbers = np.flatnonzero(lengths == length)
        most = max(1, NEIGHBOURS_AT_ONCE // (int(length) * (2 * symbols + 1)))
        for start in range(0, len(numbers), most):
            some = numbers[start : start + most]
            codes = np.frombuffer("".join(words[i] for i in some).encode("latin-1"), np.uint8)
            yield some, dealt[codes].reshape(len(some), length)


def near_pairs(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, near, near_n for all words of the vocabulary (word, n) that are one insertion,
    deletion or replacement of a code point apart, both ways round."""
    context = vocabulary.sparkSession.sparkContext
    dealt = context.broadcast(symbols_of(vocabulary, symbols))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            words = batch.column(0).to_pylist()
            keys = np.zeros(len(words), np.uint64)
            for some, reduced in _by_length(words, dealt.value, symbols):
                keys[some] = reduced_keys(reduced)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *batch.columns], ["key", "near", "near_n"])

    named = store(vocabulary.select("word", "n").mapInArrow(reduce, "key long, near string, near_n long"), "reduced")
    # Fixed in size: neighbours that are no word are mostly left out before the join.
    known = context.broadcast(bit_filter(named.select(F.pmod("key", F.lit(FILTER_BITS)).alias("at"))))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            column = batch.column(0)
            for some, reduced in _by_length(column.to_pylist(), dealt.value, symbols):
                for rows, keys in neighbour_keys(reduced, symbols):
                    at = (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                    hit = bits_at(known.value, at)
                    if hit.any():
                        words = column.take(pa.array(some[rows[hit]]))
                        yield pa.RecordBatch.from_arrays([pa.array(keys[hit].view(np.int64)), words], ["key", "word"])

    reached = vocabulary.select("word").mapInArrow(neighbours, "key long, word string")
    pairs = reached.join(named, "key")
    return pairs.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


def roots_of(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): the forms followed to the last. A form has many times
    the occurrences of its word, so a chain is short; each round doubles what is followed."""
    found = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("last"))
        found = store(
            found.join(further, "root", "left").select(
                "word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")
            ),
            "roots",
        )
        if not found.filter("moved").limit(1).count():
            return found.drop("moved")
        found = found.drop("moved")


def spelling_variants(vocabulary: DataFrame, factor: int = FACTOR, symbols: int = SYMBOLS) -> DataFrame:
    """One row per word of the vocabulary (word, n): word, form, root, n, n_near, form_n.

    Words have code points up to U+00FF and are distinct. A word's form is the near word
    with the largest n, of ties the smallest, if that has `factor` times the word's n; else
    form and form_n are null. root is the end of the chain of forms, the word itself
    without one. An empty vocabulary gives no rows.
    """
    near = near_pairs(vocabulary, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    )
    often = -F.col("best.order") >= factor * F.col("n")
    formed = store(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.order")).alias("form_n"),
        ),
        "forms",
    )
    roots = roots_of(formed.filter(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts hold no words, a null doc_id is written as nothing; repeated rows
    count each. Other columns are not read."""
    words = word_counts(table(spark, sf_dir, "documents"), slip_every=31)
    return spelling_variants(store(words, "vocabulary"))
