"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Each class has a model of order `ORDER`: a letter given the letters before it in its word.
Both back off to one shared model, Kneser-Ney by continuation counts, gathered from every
document, labelled or not. An expression that is rare in the labels is thus judged alike by
both and moves no score. Letters rather than words, because insults are inflected and
compounded into words that no label has shown.

A word's evidence is its log-likelihood under the toxic model less that under the ordinary
one; a document's is the sum of what passes a margin over its length, for the whole and for
its most suspicious stretch. A logistic curve, fitted on labelled rows kept out of the class counts, turns the
two into a probability.

Where an n-gram is in no labelled row, the shared probability cancels out of the ratio: what
is left depends on the context alone, and is nothing where the context is unseen too. So
the scoring needs the evidence of the labelled rows' n-grams only. All counts are exact and
keyed by the n-gram; the corpus is counted, and both are joined, by Spark. The table sent to
the tasks is bounded by `FIT_ROWS`, the labelled rows that the classes are fitted on.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilayer.llm.common import FILTER_BITS, bit_filter, bits_at, slices, store, table
from trilayer.llm.words import MEMORY, MEMORY_BYTES, mix, word_lists

ORDER = 5
DISCOUNT = 0.75
#: Weight of the shared model in a class, in observations, beside the discounted ones.
STRENGTH = 16.0
#: Evidence that a word has to pass: what a language's share in the labels makes of its
#: ordinary words, and the noise of rare ones, stays below. And the least a feature counts.
MARGIN, FLOOR = 1.0, 0.01
#: Labelled rows that classes and curve are fitted on, about; a quarter is the curve's.
FIT_ROWS = 50_000
#: Rows and distinct words a task derives its lists and arrays from at a time.
ROWS, WORDS_AT_ONCE = 256, 20_000
#: Bytes of a word; a longer one is judged in pieces of so many.
LONGEST = 1000
#: Words of the stretches whose evidence is compared.
STRETCH = 48
FOLDS, HELD_OUT, CURVE_FOLD = 5, 0, 1
#: Marks before and after a word: white space, which no word holds.
START, END = " ", "\n"
_EDGES = b".,;:!?\"'()[]{}<>|/\\*&%$#@~^_=+-"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Lists of a whole text's words, a bounded number of bytes at a time."""
    for words in word_lists(text):
        if max(map(len, words), default=0) > LONGEST:
            words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
        yield words


def _letters(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words between their marks, and which of them end an n-gram."""
    plain = [w.strip(_EDGES).decode("utf-8", "replace").lower() for w in words]
    marks = START * (ORDER - 1)
    codes = np.frombuffer("".join([f"{marks}{w}{END}" for w in plain]).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, plain), np.int64, len(plain)) + 1
    return codes, np.repeat(np.cumsum(sizes + ORDER - 1) - sizes, sizes) + _places(sizes)


def _places(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for every size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def gram_names(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of the `ORDER` letters that end at each place, and of all but the last."""
    parts = mix(codes.astype(np.uint64) + np.uint64(1))
    context = np.zeros(len(codes), np.uint64)
    for back in range(ORDER - 1, 0, -1):
        context = context * _STEP
        context[back:] += parts[:-back]
    return mix(context * _STEP + parts), mix(context)


def _counted_grams(words: Sequence[bytes], weights: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct n-grams of the words, as texts, and their weights."""
    codes, ends = _letters(words)
    sizes = np.diff(np.flatnonzero(np.concatenate((codes == ord(END), [True]))), prepend=-1)[: len(words)]
    weight = np.repeat(weights, sizes - (ORDER - 1))
    names, _ = gram_names(codes)
    _, first, at = np.unique(names[ends], return_index=True, return_inverse=True)
    letters = np.stack([codes[ends[first] - back] for back in range(ORDER - 1, -1, -1)], axis=1)
    grams = pa.array(np.ascontiguousarray(letters).view(f"<U{ORDER}").ravel().tolist(), pa.string())
    return grams, np.bincount(at, weights=weight, minlength=len(first)).astype(np.int64)


def _gram_counts(rows: DataFrame, kind: str | None = None) -> DataFrame:
    """gram, kind, n over all texts; a task counts words first. `kind` names a column of
    small whole numbers, without it all rows are of kind 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            for of, counter in words.items():
                for some in batched(counter.items(), WORDS_AT_ONCE):
                    grams, n = _counted_grams([w for w, _ in some], np.fromiter((c for _, c in some), np.int64, len(some)))
                    arrays = [grams, pa.array(np.full(len(n), of, np.int32)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(arrays, ["gram", "kind", "n"])
                counter.clear()

        words: dict[int, Counter] = {}
        for batch in slices(batches, ROWS):
            kinds = batch.column(1).to_pylist() if kind else [0] * batch.num_rows
            for text, of in zip(batch.column(0), kinds):
                for some in words_of(text.as_py()):
                    words.setdefault(of, Counter()).update(some)
            if sum(map(len, words.values())) > 5 * WORDS_AT_ONCE:
                yield from flush()
        yield from flush()

    counted = rows.select("text", *([kind] if kind else [])).mapInArrow(count, "gram string, kind int, n long")
    return counted.groupBy("gram", "kind").agg(F.sum("n").alias("n"))


def _shared(grams: DataFrame) -> DataFrame:
    """gram, p: the shared model's probability of every n-gram (gram, n) of the corpus.

    Below the highest order a count is that of the letters seen before: how many longer
    n-grams end in this one. Contexts and endings of an n-gram are as many as there are
    letters at most, so no group is large.
    """
    orders = [grams]
    for _ in range(ORDER - 1):
        shorter = F.expr("substring(gram, 2)").alias("gram")
        orders.append(orders[-1].select(shorter).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    letters = store(orders.pop(), "letters")
    every = letters.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")).first()
    base = 1 / ((every["types"] or 0) + 1)
    total, types = every["total"] or 1, every["types"]
    known = letters.select("gram", ((F.col("n") - DISCOUNT + DISCOUNT * types * base) / total).alias("p"))
    while orders:
        context = Window.partitionBy(F.expr(f"substring(gram, 1, {ORDER - len(orders)})"))
        of = orders.pop().withColumn("total", F.sum("n").over(context)).withColumn("types", F.count(F.lit(1)).over(context))
        lower = known.select(F.col("gram").alias("ending"), F.col("p").alias("lower"))
        joined = of.withColumn("ending", F.expr("substring(gram, 2)")).join(lower, "ending")
        p = (F.col("n") - DISCOUNT + DISCOUNT * F.col("types") * F.col("lower")) / F.col("total")
        known = joined.select("gram", p.alias("p"))
    return known


class Models:
    """Evidence of the n-grams and contexts of the labelled rows, and the curve."""

    def __init__(self, grams: Sequence[str] = (), values: Sequence[float] = (), contexts: Sequence[str] = (), defaults: Sequence[float] = ()):
        self.grams, self.values = self._sorted(grams, values, 0)
        self.contexts, self.defaults = self._sorted(contexts, defaults, 1)
        self.curve = np.array([0.0, 0.0, -1.0])

    @staticmethod
    def _sorted(texts: Sequence[str], values: Sequence[float], which: int) -> tuple[np.ndarray, np.ndarray]:
        # A context is named as an n-gram of which the last letter does not count.
        codes = np.frombuffer("".join(t + END * which for t in texts).encode("utf-32-le"), np.uint32)
        names = gram_names(codes)[which][ORDER - 1 :: ORDER]
        order = np.argsort(names)
        return names[order], np.asarray(values, np.float32)[order]

    def evidence(self, words: Sequence[bytes]) -> np.ndarray:
        """Log-likelihood of each word under the toxic model less that under the ordinary one."""
        codes, ends = _letters(words)
        names, contexts = gram_names(codes)
        names, contexts = names[ends], contexts[ends]
        found = np.zeros(len(codes), np.float64)
        values, seen = self._look_up(self.grams, self.values, names)
        others = ~seen
        values[others] = self._look_up(self.contexts, self.defaults, contexts[others])[0]
        found[ends] = values
        starts = np.concatenate(([0], np.flatnonzero(codes == ord(END))[:-1] + 1))
        return np.add.reduceat(found, starts)

    @staticmethod
    def _look_up(names: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(names):
            return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        seen = names[at] == wanted
        return np.where(seen, values[at], 0.0), seen

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (np.log(features + FLOOR) * self.curve[:2]).sum(axis=1) + self.curve[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class WordEvidence:
    """Evidence of words, in bulk for those not yet remembered."""

    def __init__(self, models: Models):
        self.models, self.memory, self.held = models, {}, 0

    def of_texts(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        found: list[list[np.ndarray]] = [[np.zeros(0)] for _ in texts]
        some, held = [], 0
        for at, text in enumerate(texts):
            for words in words_of(text):
                some.append((at, words))
                held += len(words)
                if held > 10 * WORDS_AT_ONCE:
                    self._judge(some, found)
                    some, held = [], 0
        self._judge(some, found)
        return [np.concatenate(parts) for parts in found]

    def _judge(self, lists: list[tuple[int, list[bytes]]], found: list[list[np.ndarray]]) -> None:
        if len(self.memory) > MEMORY // 2 or self.held > MEMORY_BYTES:
            self.memory.clear()
            self.held = 0
        unseen = {w for _, words in lists for w in words if w not in self.memory}
        for some in batched(unseen, WORDS_AT_ONCE):
            self.memory.update(zip(some, self.models.evidence(some).tolist()))
        self.held += sum(map(len, unseen))
        for at, words in lists:
            found[at].append(np.fromiter(map(self.memory.__getitem__, words), float, len(words)))


def features_of(evidence: np.ndarray) -> tuple[float, float]:
    """Evidence beyond the margin per word, of the whole text and of its most suspicious stretch."""
    n = len(evidence)
    if not n:
        return 0.0, 0.0
    total = np.concatenate(([0.0], np.cumsum(np.maximum(evidence - MARGIN, 0))))
    width = min(n, STRETCH)
    return total[n] / n, float((total[width:] - total[:-width]).max()) / STRETCH


def fit_counts(docs: DataFrame, labelled: DataFrame) -> Models:
    """`labelled` has text and toxic, `docs` text; the labelled rows are among the docs'.
    Empty tables give models of no evidence."""
    corpus = store(_gram_counts(docs).select("gram", "n"), "corpus-grams")
    classed = _gram_counts(labelled, "toxic").groupBy("gram").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == c, F.col("n"))), F.lit(0)).alias(f"n{c}") for c in (0, 1)]
    )
    context = F.expr(f"substring(gram, 1, {ORDER - 1})")
    together = Window.partitionBy("context")
    classed = classed.withColumn("context", context)
    for c in (0, 1):
        classed = classed.withColumn(f"total{c}", F.sum(f"n{c}").over(together))
        classed = classed.withColumn(f"types{c}", F.count_if(F.col(f"n{c}") > 0).over(together))
    classed = store(classed, "class-grams").join(_shared(corpus), "gram")

    def free(c: int) -> Column:
        """The share of the shared model in a class, in a context."""
        return (STRENGTH + DISCOUNT * F.col(f"types{c}")) / (STRENGTH + F.col(f"total{c}"))

    def likelihood(c: int) -> Column:
        return F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)) / (STRENGTH + F.col(f"total{c}")) + free(c) * F.col("p")

    judged = store(
        classed.select(
            "gram", "context", (F.log(likelihood(1)) - F.log(likelihood(0))).cast("float").alias("evidence"),
            (F.log(free(1)) - F.log(free(0))).cast("float").alias("default"),
        ),
        "evidence",
    )
    # Bounded by the labelled rows that were counted.
    grams = judged.select("gram", "evidence").toArrow()
    contexts = judged.groupBy("context").agg(F.first("default").alias("default")).toArrow()
    return Models(*(c.to_pylist() for t in (grams, contexts) for c in t.columns))


def _featured(docs: DataFrame, models: Models, keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = WordEvidence(shared.value)
        for batch in slices(batches, ROWS):
            pairs = [features_of(e) for e in evidence.of_texts(batch.column("text").to_pylist())]
            values = np.array(pairs, float).reshape(-1, 2)
            score = shared.value.score(values)
            columns = [batch.column(c) for c in keep] + [pa.array(v) for v in (*values.T, score)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "mean_evidence", "peak_evidence", "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return docs.select(*dict.fromkeys(["text", *keep])).mapInArrow(
        featured, f"{schema}, mean_evidence double, peak_evidence double, score double"
    )


def fit_curve(values: np.ndarray, toxic: np.ndarray, steps: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton's method; weights and intercept."""
    if not len(toxic) or toxic.min() == toxic.max():
        return np.array([0.0, 0.0, -1.0])
    scale = np.maximum(values.std(axis=0), 1e-9)
    x = np.column_stack((values / scale, np.ones(len(values))))
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip((x * w).sum(axis=1), -30, 30)))
        slope = (x * (p - toxic)[:, None]).sum(axis=0) + 0.05 * w * (1, 1, 0)
        bend = np.einsum("ni,n,nj->ij", x, p * (1 - p), x) + np.diag([0.05, 0.05, 1e-9])
        step = np.linalg.solve(bend, slope)
        w = w - step / max(1.0, np.abs(step).max())
    return np.append(w[:2] / scale, w[2])


def _likely(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (doc_id, text) whose id is among `ids`, and some others, found within the task."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("at")
    known = texts.sparkSession.sparkContext.broadcast(bit_filter(ids.select(place)))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = bits_at(known.value, batch.column(2).to_numpy())
            yield batch.filter(pa.array(keep)).select([0, 1])

    rows = texts.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", place)
    return rows.mapInArrow(chosen, "doc_id long, text string")


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Models:
    """Models from the labelled rows outside the held-out fold.

    Rows of doc_ids with several labels count once for each. Null labels and null
    doc_ids are left out, and so are labels other than 0 and 1.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    known = store(known.filter(fold_of(F.col("doc_id")) != HELD_OUT), "known-labels")
    # Rows are taken by a hash of their id, so no task has to bring them together.
    share = min(1.0, FIT_ROWS / max(known.count(), 1))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < int(share * 2**31))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    likely = _likely(texts, known.select("doc_id"))
    labelled = store(likely.join(known, "doc_id"), "labelled")
    of_curve = fold_of(F.col("doc_id")) == CURVE_FOLD
    models = fit_counts(texts, labelled.filter(~of_curve))
    sample = labelled.filter(of_curve).select("toxic", "text")
    rows = _featured(sample, models, ["toxic"]).toPandas()
    rows = rows.sort_values(["mean_evidence", "peak_evidence", "toxic"])
    values = rows[["mean_evidence", "peak_evidence"]].to_numpy(float).reshape(-1, 2)
    models.curve = fit_curve(np.log(values + FLOOR), rows.toxic.to_numpy(float))
    return models


def score_toxicity(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, score (0 to 1) and predicted for every row, by its whole text alone.

    Null and empty texts carry no evidence and get the curve's value at 0. Repeated
    rows get the same score each. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = _featured(texts, models, ["doc_id"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, models: Models, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score is below `threshold`, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = WordEvidence(shared.value)
        for batch in slices(batches, ROWS):
            pairs = [features_of(e) for e in evidence.of_texts(batch.column(at).to_pylist())]
            scores = shared.value.score(np.array(pairs, float).reshape(-1, 2))
            yield batch.filter(pa.array(scores < threshold))

    at = docs.columns.index("text")
    return docs.mapInArrow(clean, docs.schema)


def crc32_fold(doc_id: int) -> int:
    """The fold of an id, for tests and single rows."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, models)
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        "predicted",
        "mean_evidence",
        "peak_evidence",
    )
