"""Operators against plain versions of the same method, written without the library's code."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from llm_fixtures import empty, messy, workers_import_the_library  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

import corpus_pipeline
from trilayer.functions import hash_uniform
from trilayer.llm import near_dedup, warc
from trilayer.llm.exact_dedup import drop_copies
from trilayer.llm.fingerprints import INNER, SKETCH, K, fingerprint_edits
from trilayer.llm.mixing import TARGETS, rake
from trilayer.llm.near_dedup import drop_near_copies, near_groups
from trilayer.llm.packing import inverse_of, plan_sequences
from trilayer.llm.queries import QUERIES
from trilayer.llm.token_count import default_model
from trilayer.llm.toxicity import DISCOUNT, LONGEST, ORDER, STRENGTH, WordEvidence, fit_counts


@pytest.fixture(scope="module")
def documents(sf_dir):
    found = duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf_dir}/documents.parquet' order by doc_id")
    return dict(found.fetchall())


# --- toxicity ------------------------------------------------------------------------


def grams(word):
    text = " " * (ORDER - 1) + word.strip(".,;:!?\"'()[]{}<>|/\\*&%$#@~^_=+-").lower() + "\n"
    return [text[i : i + ORDER] for i in range(len(text) - ORDER + 1)]


def kneser_ney(texts, labelled):
    """word -> evidence, from all texts and from (text, class) rows."""
    counts = [Counter(g for t in texts for w in t.split() for g in grams(w))]
    for _ in range(ORDER - 1):
        counts.append(Counter(g[1:] for g in counts[-1]))
    totals, kinds = ([defaultdict(int) for _ in counts] for _ in range(2))
    for level, table in enumerate(counts):
        for g, n in table.items():
            totals[level][g[:-1]] += n
            kinds[level][g[:-1]] += 1
    letters = len(counts[-1])

    def shared(g, level=0):
        lower = 1 / (letters + 1) if level == ORDER - 1 else shared(g[1:], level + 1)
        h = g[:-1]
        return (counts[level][g] - DISCOUNT + DISCOUNT * kinds[level][h] * lower) / totals[level][h]

    of = {c: Counter(g for t, k in labelled if k == c for w in t.split() for g in grams(w)) for c in (0, 1)}
    total, types = ({c: Counter() for c in of} for _ in range(2))
    for c, table in of.items():
        for g, n in table.items():
            total[c][g[:-1]] += n
            types[c][g[:-1]] += 1

    def letter(g):
        h = g[:-1]
        free = {c: (STRENGTH + DISCOUNT * types[c][h]) / (STRENGTH + total[c][h]) for c in of}
        if not of[0][g] + of[1][g]:
            return math.log(free[1] / free[0])
        p = {c: max(of[c][g] - DISCOUNT, 0) / (STRENGTH + total[c][h]) + free[c] * shared(g) for c in of}
        return math.log(p[1] / p[0])

    return lambda word: sum(map(letter, grams(word)))


def test_toxicity_evidence_is_that_of_the_models(spark):
    rng = random.Random(4)
    syllables = ["ba", "né", "lo", "sch", "ti", "日", "x"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(60)] + ["Idiot!", "(scum)", "..."]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(80)]
    labelled = [(t + " scum idiot" * (i % 3 == 0), int(i % 3 == 0)) for i, t in enumerate(texts[:40])]
    corpus = texts + [t for t, _ in labelled]
    models_ = fit_counts(
        spark.createDataFrame([(t,) for t in corpus] + [(None,)], "text string"),
        spark.createDataFrame(labelled, "text string, toxic int"),
    )
    plain = kneser_ney(corpus, labelled)
    asked = [*words, "unseen", "idi", "ſtrange", "日日日", "scumlo"]
    got = models_.evidence([w.encode() for w in asked])
    assert got == pytest.approx([plain(w) for w in asked], abs=2e-4)
    assert plain("idiot") > 0.5 > plain(words[0])
    long = "a" * (2 * LONGEST + 5)
    (evidence,) = WordEvidence(models_).of_texts([f"{long} ba"])
    assert len(evidence) == 4 and np.isfinite(evidence).all()


# --- fingerprints --------------------------------------------------------------------


def chain(values):
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - 2**64 if seed >= 2**63 else seed


def anchors(text):
    units = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]
    if not units:
        return set()
    if len(units) < K:
        units = list(text)
        if len(units) < K:
            return {chain([text])}
    h = [chain([u]) for u in units]
    s = [chain(h[i : i + INNER]) for i in range(len(h) - INNER + 1)]
    last, found = K - INNER, set()
    for i in range(len(h) - K + 1):
        window = s[i : i + last + 1]
        if min(window[0], window[-1]) <= min(window[1:-1]):
            found.add(chain(h[i : i + K]))
    return found


def sketched(text):
    return sorted({a & 0xFFFFFFFF for a in anchors(text)})[:SKETCH]


def alike(a, b):
    union = sorted({*a, *b})[:SKETCH]
    return 1.0 if not union else len(set(a) & set(b) & set(union)) / len(union)


def test_fingerprints_and_likenesses(spark, sf_dir, documents):
    ids = list(documents)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    for r in QUERIES["op2_fingerprints"](spark, sf_dir).collect():
        text, other = documents[r.doc_id], documents[after[r.doc_id]]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        own, changed, following = sketched(text), sketched(edited), sketched(other)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{v:08x}" for v in own)
        assert r.edited_fingerprint == "".join(f"{v:08x}" for v in changed)
        assert r.near_edited == pytest.approx(alike(own, changed)) and r.near_next == pytest.approx(alike(own, following))


def test_a_text_without_blanks_keeps_its_anchors(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijklmnop日") for _ in range(3000))
    rows = spark.createDataFrame([(1, text), (2, text[:1400] + "#" + text[1400:])], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint_edits(rows).collect()}
    assert got[1].near_next > 0.8 and got[1].near_next == pytest.approx(alike(sketched(text), sketched(text[:1400] + "#" + text[1400:])))


# --- token counts --------------------------------------------------------------------


def test_token_counts_of_every_text(spark, sf_dir, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=default_model())
    ids = range(model.vocab_size())
    plain = [(model.id_to_piece(i), model.get_score(i)) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    low = min(s for _, s in plain)
    # Byte pieces are there to fall back to; as pieces of text they can match nothing.
    vocabulary = [("<unk>", 0.0), *plain, *((f"<0x{b:02X}>", low) for b in range(256))]
    theirs = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, sf_dir).collect()}
    assert set(got) == set(documents)
    counted = {}
    for i, text in documents.items():
        words = [w.decode() for w in text.encode().split()]
        for w in set(words) - set(counted):
            counted[w] = len(theirs.encode("▁" + w, add_special_tokens=False).ids)
        assert got[i].n_words == len(words)
        assert got[i].n_tokens == sum(counted[w] for w in words), i


# --- archives ------------------------------------------------------------------------


def test_any_page_id_and_records_by_their_place(spark, tmp_path, monkeypatch):
    html = "<p>" + "x" * 200
    ids = [2**62, -(2**62), None, 2**63 - 1, -(2**63), 400_000_000_000, 0, 0]
    rows = [(i, f"http://h{n % 3}/é", [html, html, html, "z", "é" * 700_000, None, html, html][n]) for n, i in enumerate(ids)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    # Records of several members, and ranges of few entries.
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 2)
    got = warc.archive_pages(pages, path=path).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(map(str, ids))
    order = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in got]
    assert order == sorted(order)
    for r in got:
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r.captured_at)
        headers, payload = warc.read_record(spark, path, r.file, r.offset, r.length)
        assert headers["WARC-Record-ID"] == f"<urn:page:{'' if r.page_id is None else r.page_id}>"
        if r.record_type == "response":
            assert hashlib.sha256(payload).hexdigest() == r.payload_digest
        else:
            assert r.refers_to == -(2**62) and payload == b""
    # Any reader of gzip takes a file for one stream of records.
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in Path(path).glob("part-*"))
    assert whole.count(b"WARC/1.1\r\n") == len(ids)


def test_records_of_several_members(monkeypatch):
    record = b"WARC/1.1\r\nContent-Length: 100\r\n\r\n" + b"y" * 100 + b"\r\n\r\n"
    cut = b"".join(zlib.compress(record[i : i + 37], wbits=31) for i in range(0, len(record), 37))
    data = cut + zlib.compress(record, wbits=31)
    monkeypatch.setattr(warc, "_WINDOW", 7)
    found = list(warc.parse_archive(data))
    assert [(at, size, block) for _, at, size, block in found] == [(0, len(cut), b"y" * 100), (len(cut), len(data) - len(cut), b"y" * 100)]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_archive(data[:-5]))


# --- near-duplicates -----------------------------------------------------------------


def crowd(pairs, core, both, own):
    common = " ".join(f"c{i}" for i in range(core))
    for p in range(pairs):
        shared = " ".join(f"p{p}x{j}" for j in range(both))
        for side in (0, 1):
            yield 2 * p + side, f"{common} {shared} " + " ".join(f"d{p}s{side}x{j}" for j in range(own))


@pytest.mark.parametrize("pairs, core, both, own", [(3000, 275, 2, 23), (800, 200, 5, 14), (40, 275, 2, 23)])
def test_no_link_is_lost_in_a_crowd(spark, pairs, core, both, own):
    """Each is linked with one, and nearly so with all others."""
    linked, others = (core + both) / (core + both + 2 * own), core / (core + 2 * (both + own))
    assert linked >= 0.85 > others > 0.8
    rows = spark.createDataFrame(list(crowd(pairs, core, both, own)), "doc_id long, text string").repartition(16)
    got = {r.doc_id: r.component_id for r in near_groups(rows, words=1).collect()}
    assert got == {i: i - i % 2 for i in range(2 * pairs)}


def test_crowded_regions_against_all_pairs(spark, monkeypatch):
    """Chains, cliques and lone sets around one core, all of it above the crowded size."""
    monkeypatch.setattr(near_dedup, "CROWDED", 4)
    rng = random.Random(8)
    rows = []
    for i in range(300):
        words = [f"c{j}" for j in range(100) if rng.random() > 0.02 * (i % 7)]
        rows.append((i, " ".join(words + [f"u{i % 23}x{j}" for j in range(rng.randint(0, 12))])))
    sets = {i: set(t.split()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j in range(i):
            n = len(s & sets[j])
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = near_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: find(i) for i in sets}
    assert len({find(i) for i in sets}) > 10


def test_rows_are_dropped_and_not_ids(spark, tmp_path):
    rows = [(1, "A b c d e f g"), (5, "A b c d e f g"), (5, "quite another text of seven words"), (None, "x y"), (None, "x y"), (7, None), (7, ""), (8, None)]
    df = spark.createDataFrame([(*r, n, n) for n, r in enumerate(rows)], "doc_id long, text string, `_row` int, node int").drop("_row")
    df.repartition(3).write.parquet(str(tmp_path / "d"))
    for docs in (df, spark.read.parquet(str(tmp_path / "d"))):
        near = drop_near_copies(docs)
        assert near.columns == docs.columns
        assert Counter((r.doc_id, r.text) for r in near.collect()) == Counter([rows[0], rows[2], rows[3], *rows[5:]])
        exact = Counter((r.doc_id, r.text) for r in drop_copies(docs, "largest").collect())
        assert exact == Counter([rows[1], rows[2], rows[3], rows[7]])


# --- mixing and packing ---------------------------------------------------------------


def test_mixing_rates_and_draws(spark, sf_dir):
    """Every row's probability is its cell's, from cells counted and raked by hand."""
    got = QUERIES["op9_mixing"](spark, sf_dir).toPandas()
    margins = {"source_margin": TARGETS["source"], "lang_margin": TARGETS["lang"], "topic_margin": TARGETS["topic"]}
    cells = got.groupby(list(margins)).tokens.sum()
    cells = cells[cells > 0]
    weight = cells / cells.sum()
    goals = []
    for level, (name, target) in enumerate(margins.items()):
        goal = {v: target.get(v, max(0.0, 1 - sum(target.values()))) for v in cells.index.get_level_values(name).unique()}
        goals.append((name, {v: s / sum(goal.values()) for v, s in goal.items()}))
    for _ in range(3000):
        for name, goal in goals:
            sums = weight.groupby(level=name).transform("sum")
            weight = weight * weight.index.get_level_values(name).map(goal).to_numpy() / sums
    factor = weight / (cells / cells.sum())
    rate = (factor / factor.max()).to_dict()
    draws = spark.createDataFrame(got[["doc_id"]]).select("doc_id", hash_uniform(0, "mixing", F.col("doc_id").cast("string")).alias("u"))
    u = {r.doc_id: r.u for r in draws.collect()}
    for r in got.itertuples():
        wanted = rate.get((r.source_margin, r.lang_margin, r.topic_margin), 1.0)
        assert r.probability == pytest.approx(wanted, abs=1e-6)
        assert r.kept == (u[r.doc_id] < r.probability)


def test_margins_that_contradict_the_cells(caplog):
    cells, goals = np.array([[10.0, 0.0], [0.0, 5.0]]), [np.array([0.5, 0.5]), np.array([0.9, 0.1])]
    with pytest.raises(ValueError, match="contradict"):
        rake(cells, goals, strict=True)
    assert np.isfinite(rake(cells, goals)).all() and "contradict" in caplog.text


def test_inverse_and_plan():
    rng = np.random.default_rng(1)
    for n in (1, 2, 17, 120):
        m = rng.standard_normal((n, n))
        assert np.abs((inverse_of(m)[:, :, None] * m[None]).sum(axis=1) - np.eye(n)).max() < 1e-8
    histogram = {int(s): int(c) for s, c in zip(range(1, 257), rng.integers(0, 900, 256)) if c}
    rows, sequences = plan_sequences(histogram, 256)
    filled = np.zeros(sequences, np.int64)
    for at, (size, first, each, sequence) in enumerate(rows):
        ends_here = at + 1 == len(rows) or rows[at + 1][0] != size
        for rank in range(first, histogram[size] if ends_here else rows[at + 1][1]):
            filled[sequence + (rank - first) // each] += size
    assert filled.max() <= 256 and filled.sum() == sum(s * n for s, n in histogram.items())


# --- pipeline -------------------------------------------------------------------------


def test_pipeline_over_rows_that_are_not_clean(spark, sf_dir, messy, empty):
    for docs in (messy, empty):
        before = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = corpus_pipeline.store(stage(spark, before, sf_dir), f"messy-{name}")
            assert after.columns == docs.columns and after.count() <= before.count(), name
            before = after
        pieces = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
        assert pieces.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
