"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from llm_fixtures import by_id, empty, messy, workers_import_the_library  # noqa: F401
from pyspark.sql import functions as F
from trilayer.llm.chat import format_chats
from trilayer.llm.exact_dedup import drop_copies, exact_groups
from trilayer.llm.fingerprints import fingerprint_edits
from trilayer.llm.mixing import calibrated, mix_sources
from trilayer.llm.near_dedup import drop_near_copies, near_groups
from trilayer.llm.packing import pack
from trilayer.llm.token_count import count_tokens
from trilayer.llm.toxicity import drop_toxic, fit_toxicity, score_toxicity
from trilayer.llm.url_filter import judge_urls, rule_keys
from trilayer.llm.warc import archive_pages

PAGES = "page_id long, url string, html string, host string, payload string, run string"
RULES = "host string, path string, verdict string"
TURNS = "conv_id long, turn int, role string, text string, place string, block string"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, text string")


def test_url_filter(spark):
    urls = ["http://a.ORG/fr/x?q", "no scheme", None, "://", "http://x.net", "http://x.net", "http://example.net/en/#a"]
    pages = spark.createDataFrame([(i, u, None, "a", "b", "c") for i, u in enumerate(urls)], PAGES)
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow")], RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got[0] == ("a.org", "/fr/x", "org/fr/", "allow")
    assert [got[i][:2] for i in (1, 2, 3)] == [("", "")] * 3
    assert got[4] == got[5] == ("x.net", "", None, "allow")
    assert got[6] == ("example.net", "/en/", "example.net/en/", "allow")
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_url_filter_of_hosts_with_many_labels(spark):
    hosts = ["a." * 5000 + "net", "net", "b.c.d", "c.d", "d", "x.b.c.d.", "xnet", "..net", "", "."]
    rows = [(i, f"http://{host}/en/{'p/' * 2000}", None, "a", "b", "c") for i, host in enumerate(hosts)]
    rules = [("net", "/en/", "block"), ("b.c.d", "/", "allow"), ("d", "/e", "block"), ("c.d", "/en/p/p/", "block")]
    rules += [(None, "/", "block"), ("net", "/en/", None)]
    got = judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, RULES)).collect()
    for row in got:
        fits = [
            (len(h + p), len(h), h + p, v) for h, p, v in rules[:4]
            if (row.host == h or row.host.endswith("." + h)) and row.path.startswith(p)
        ]
        assert (row.rule, row.verdict) == (max(fits)[2:] if fits else (None, "allow")), row.host[-20:]
    assert len(got) == len(rows) and sum(r.rule is not None for r in got) == 6


def test_url_filter_keys_are_bounded_by_the_rules(spark):
    url = spark.createDataFrame([("a." * 5000 + "net", "/" * 5000)], "host string, path string")
    keys = url.select(rule_keys(F.col("host"), F.col("path"), [1, 3], [0, 4]).alias("keys")).first()["keys"]
    assert keys == ["a.a.net////", "a.a.net", "net////", "net"]


def test_fingerprints(spark, messy, empty):
    got = fingerprint_edits(messy).collect()
    assert len(got) == messy.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert fingerprint_edits(empty).count() == 0
    one = fingerprint_edits(messy.filter("doc_id = 10")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_toxicity(spark, messy, empty):
    models = fit_toxicity(messy, labels(spark, [(1, 1, "x"), (2, 0, "x"), (2, None, "x"), (None, 1, "x"), (6, 7, "x")]))
    got = score_toxicity(messy, models).collect()
    assert len(got) == messy.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert drop_toxic(messy, models).columns == messy.columns
    bare = fit_toxicity(empty, labels(spark, []))
    assert score_toxicity(empty, bare).count() == 0
    assert {r.predicted for r in score_toxicity(messy, bare).collect()} == {0}


def test_warc(spark):
    html = "<p>" + "x" * 200
    rows = [(3, "http://b/", html), (2, "http://a/", html), (2, "http://a/", html), (4, None, None), (5, "u\r\nv", "a\r\nb\n")]
    rows += [(6, "http://c", ""), (7, "http://é", "short"), (8, "http://é", "short"), (9, "http://l", "é" * 300_000)]
    pages = spark.createDataFrame([(*r, "h", "p", "r") for r in rows], PAGES)
    got = archive_pages(pages).collect()
    assert len(got) == len(rows)
    kinds = by_id(got, "page_id")
    assert (kinds[3].record_type, kinds[3].refers_to, kinds[3].payload_bytes) == ("revisit", 2, 203)
    assert all(kinds[i].record_type == "response" and kinds[i].refers_to is None for i in (2, 4, 5, 6, 7, 8, 9))
    assert kinds[9].payload_bytes == 600_000 and kinds[4].payload_bytes == 0 and kinds[5].payload_bytes == 5
    assert archive_pages(pages.limit(0)).count() == 0


def test_token_counts(messy, empty):
    got = count_tokens(messy).collect()
    assert len(got) == messy.count()
    assert all(r.n_tokens == 0 for r in got if r.doc_id in (3, 4, 5))
    assert len({r.n_tokens for r in got if r.doc_id in (6, 7)}) == 1
    assert count_tokens(empty).count() == 0


@pytest.mark.parametrize("keep, kept", [("smallest", {1, 2, 3, 5, 6, 8, 9, 10}), ("largest", {1, 2, 4, 5, 7, 8, 9, 10})])
def test_exact_dedup(messy, empty, keep, kept):
    got = exact_groups(messy, keep).collect()
    assert len(got) == messy.count()
    assert sorted(r.doc_id for r in got if r.kept) == sorted(kept)
    assert {r.group_size for r in got if r.doc_id in (3, 4)} == {3}
    left = drop_copies(messy, keep)
    assert left.columns == messy.columns and sorted(r.doc_id for r in left.collect()) == sorted(kept)
    assert exact_groups(empty, keep).count() == 0 and drop_copies(empty, keep).count() == 0


def test_packing(messy, empty):
    got = pack(messy).collect()
    lengths = {}
    for r in got:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths[3] == lengths[4] == 1 and max(r.offset + r.length for r in got) <= 2048
    assert pack(empty).count() == 0


def test_chat_formatting(spark):
    rows = [(1, 1, "user", "hi"), (2, 1, "user", "hi"), (2, 2, "bot", "ho"), (3, 1, "user", "hi"), (3, 2, "bot", "ho")]
    rows += [(4, None, None, None), (None, 1, "user", "hi"), (5, 1, "user", ""), (5, 1, "user", ""), (6, 1, "bot", "hi")]
    turns = spark.createDataFrame([(*r, "p", "b") for r in rows], TURNS)
    got = by_id(format_chats(turns).collect(), "conv_id")
    assert set(got) == {2, 4, 5, 6} and got[2].copies == 2
    assert got[2].text == "<|user|>\nhi<|end|>\n<|bot|>\nho<|end|>\n"
    assert got[4].text == "<||>\n<|end|>\n" and got[5].n_turns == 1
    assert format_chats(turns.limit(0)).count() == 0


def test_mixing(messy, empty):
    got = calibrated(messy)
    assert got.count() == messy.count()
    assert got.filter("probability is null or probability < 0 or probability > 1").count() == 0
    assert mix_sources(messy).columns == messy.columns
    assert mix_sources(empty).count() == 0


def test_near_dedup(messy, empty):
    got = near_groups(messy).collect()
    assert len(got) == messy.count()
    component = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert component == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 8, 10: 10}
    left = drop_near_copies(messy)
    assert left.columns == messy.columns
    assert {r.doc_id for r in left.collect() if r.doc_id is not None} == {1, 3, 4, 5, 6, 8, 10}
    assert near_groups(empty).count() == 0 and drop_near_copies(empty).count() == 0
