"""Spelling variants against all pairs of words by brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import empty, messy, workers_import_the_library  # noqa: F401

from trilayer.llm import spelling
from trilayer.llm.queries import QUERIES
from trilayer.llm.spelling import (
    neighbour_keys,
    reduced_keys,
    runs_of,
    slipped,
    spelling_variants,
    word_counts,
)


def variants(words):
    """word -> all near words, by their one-place patterns."""
    near, patterns = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            patterns[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in patterns.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(words, factor=10):
    near, form = variants(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= factor * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def rows_of(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_whole_query(spark):
    # The smallest tables have no word of ten times another's count.
    sf_dir, counts = "/root/testdata/sf0.01", Counter()
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        text = re.sub("[A-Z]", lambda m: m[0].lower(), row.text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            code = zlib.crc32(f"{row.doc_id}:{run}".encode())
            if code % 31 == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    wanted = brute({w: n for w, n in counts.items() if n >= 2})
    assert rows_of(QUERIES["op12_spelling_variants"](spark, sf_dir)) == wanted
    assert sum(w[1] is not None for w in wanted) > 50


def test_crowded_and_chained_words(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abÄ") for _ in range(rng.randint(7, 9))): rng.choice([2, 3, 25, 260, 2700]) for _ in range(900)}
    words |= {"a" * 30: 5, "a" * 31: 60, "a" * 300: 2, "a" * 299 + "b": 30}
    vocabulary = spark.createDataFrame(list(words.items()), "word string, n long")
    wanted = brute(words)
    assert rows_of(spelling_variants(vocabulary)) == wanted
    assert any(w[1] and w[1] != w[2] for w in wanted)
    assert rows_of(spelling_variants(vocabulary, factor=3, symbols=3)) == brute(words, 3)


@settings(max_examples=60, deadline=None)
@given(st.text("abcd", min_size=1, max_size=9), st.integers(2, 4), st.integers(1, 400))
def test_neighbours_are_whole_and_single(word, symbols, at_once):
    reduced = np.array([[ord(c) % symbols + 1 for c in word]], np.uint64)
    whole = tuple(map(int, reduced[0]))
    wanted = {whole}
    for i in range(len(whole) + 1):
        wanted |= {whole[:i] + (s,) + whole[i:] for s in range(1, symbols + 1)}
        if i < len(whole):
            wanted.add(whole[:i] + whole[i + 1 :])
            wanted |= {whole[:i] + (s,) + whole[i + 1 :] for s in range(1, symbols + 1)}
    before, spelling.NEIGHBOURS_AT_ONCE = spelling.NEIGHBOURS_AT_ONCE, at_once
    try:
        keys = np.concatenate([k for _, k in neighbour_keys(reduced, symbols)])
    finally:
        spelling.NEIGHBOURS_AT_ONCE = before
    named = [int(reduced_keys(np.array([w], np.uint64))[0]) for w in wanted]
    assert sorted(keys.tolist()) == sorted(named)


def test_texts_are_scanned_whole():
    text = ("Abcdefg ÀB " * 50_000 + "x" * 200_000 + " ") * 2
    got = Counter(runs_of(text, 1))
    before, spelling.SCAN = spelling.SCAN, 1000
    try:
        assert Counter(runs_of(text, 1)) == got
    finally:
        spelling.SCAN = before
    assert got["abcdefg"] == 100_000 and got["Àb"] == 100_000 and got["x" * 200_000] == 2


@pytest.mark.parametrize("doc_id", [None, 0, -5, 2**62])
def test_slips(doc_id):
    runs = ["".join(p) for p in zip("abcdefghij" * 40, "klmnopqrst" * 40)]
    runs = [f"{r}{'x' * (i % 9)}" for i, r in enumerate(runs)]
    out = [slipped(doc_id, r, 5) for r in runs]
    assert all(o == r or len(o) == len(r) - 1 for o, r in zip(out, runs)) and out != runs


def test_rows_that_are_not_clean(spark, messy, empty):
    counts = {r.word: r.n for r in word_counts(messy, min_length=3, min_count=1).collect()}
    assert counts["fox"] == 3 and counts["two"] == 3 and counts["the"] > 80_000
    assert counts["ünïcödé"] == 5 and counts["end"] == 1
    assert spelling_variants(word_counts(empty)).count() == 0
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
