"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import hashlib

import brute
import pytest
from llm_fixtures import *  # noqa: F403
from llm_fixtures import clash

from rollcall.llm import decontaminate, language_id, packing, quality_ftrl, quality_rules, secrets_crf, simhash, substring_dedup, toxicity_knn, url_filter

LABELS = "doc_id bigint, quality int, toxic int"


def run(name, docs, labels):
    spark = docs.sparkSession
    items = spark.createDataFrame([(1, "the same id"), (2, None), (3, ""), (None, "x"), (4, "twice the same row")], "item_id bigint, text string")
    return {
        "secrets": lambda: secrets_crf.query(docs),
        "quality": lambda: quality_ftrl.query(docs, labels),
        "substring": lambda: substring_dedup.query(docs),
        "language": lambda: language_id.query(docs),
        "decontaminate": lambda: decontaminate.query(docs, items),
        "packing": lambda: packing.query(docs),
        "rules": lambda: quality_rules.query(docs),
        "toxicity": lambda: toxicity_knn.query(docs, labels),
        "simhash": lambda: simhash.query(docs),
    }[name]()


NAMES = ["secrets", "quality", "substring", "language", "decontaminate", "packing", "rules", "toxicity", "simhash"]


def sorted_rows(df, columns):
    return sorted(df.select(*columns).collect(), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, labelled, name):
    found = run(name, odd, labelled)
    if name != "packing":
        assert sorted(str(r.doc_id) for r in found.select("doc_id").collect()) == sorted(str(r.doc_id) for r in odd.select("doc_id").collect())
    wider = run(name, clash(odd), clash(labelled))
    assert wider.columns == found.columns
    exact = [c for c, t in found.dtypes if t not in ("double", "array<string>") and c not in ("sequence_id", "offset")]
    assert sorted_rows(wider, exact) == sorted_rows(found, exact)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, nothing, odd, labelled, name):
    assert run(name, nothing, labelled).count() == 0
    without = run(name, odd, spark.createDataFrame([], LABELS))
    assert without.count() >= odd.count()


def by_id(df, doc_id):
    return [r for r in df.collect() if r.doc_id == doc_id]


def test_defined_results(spark, odd, labelled):
    empty = hashlib.sha256(b"").hexdigest()
    for r in secrets_crf.query(odd).collect():
        if r.doc_id in (1, 2, 3):
            assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == (0, 0, 0, empty, "")
    assert by_id(secrets_crf.query(odd), 8)[0].n_assign == 1
    for r in language_id.query(odd).collect():
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 7) or r.doc_id is None and r.score == 0)
    rows = substring_dedup.query(odd)
    assert {(r.n_words, r.n_removed, r.kept_sha256) for r in rows.collect() if r.doc_id in (1, 2, 3)} == {(0, 0, empty)}
    assert by_id(rows, 9)[0].n_removed == 60_000  # a copy of document 4
    assert by_id(rows, 4)[0].n_removed > 0  # which repeats itself
    for r in packing.query(odd).collect():
        if r.doc_id in (1, 2, 3):
            assert (r.start, r.length, r.doc_tokens) == (0, 1, 1)
    for r in simhash.query(odd).collect():
        if r.doc_id in (1, 2, 3):
            assert (r.fingerprint, r.component_id) == ("0" * 16, 1)
        if r.doc_id in (4, 9):
            assert r.component_id == 4
    for r in quality_rules.query(odd).collect():
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.base_failed, r.kept) == (0, True, False)
    scores = {r.score for r in quality_ftrl.query(odd, labelled).collect() if r.doc_id in (1, 2, 3)}
    assert len(scores) == 1
    for r in decontaminate.query(odd, spark.createDataFrame([(1, "the same id")], "item_id bigint, text string")).collect():
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.n_hit, r.contaminated, r.items_sha256) == (0, 0, False, empty)
    six = by_id(decontaminate.query(odd, spark.createDataFrame([(1, "the same id")], "item_id bigint, text string")), 6)
    assert sorted(r.n_hit for r in six) == [0, 3]  # two texts under one id are told apart


def test_no_labels_defined_scores(spark, odd):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality_ftrl.query(odd, none).collect()} == {0.5}
    assert {r.score for r in toxicity_knn.query(odd, none).collect()} == {0.0}


URLS = [
    (1, "HTTP://Sub.Example.NET/en/1?x=1#y"),
    (2, "http://example.net/de/1"),
    (3, "https://a.example.com/de/"),
    (4, "https://a.example.com/en/"),
    (5, "http://x.org/fr/1"),
    (6, "http://notexample.com/de/1"),
    (7, "no scheme"),
    (8, None),
    (9, ""),
    (10, "x://net/"),
    (11, "x://net"),
    (12, "x://a.net?q=/fr/"),
    (13, "http://ÄÖ.org/fr/é#/"),
    (14, "http://a.org/fr/" + "x/" * 20_000),
    (None, "http://x.org/fr/1"),
    (5, "http://x.org/fr/1"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(*x, None) for x in URLS], "page_id bigint, url string, html string")
    rows = url_filter.query(pages).collect()
    want = sorted((str(i), *brute.url_rule(u)[:2], str(brute.url_rule(u)[2])) for i, u in URLS)
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in rows) == want
    for r in rows:
        assert r.verdict == brute.RULES[r.rule] if r.rule else r.verdict in ("allow", "block")
    assert url_filter.query(pages.limit(0)).count() == 0
    unruled = url_filter.query(pages.filter("page_id in (6, 7)")).collect()
    assert {r.verdict for r in unruled} == {"allow"}
    wider = url_filter.query(clash(pages)).collect()
    assert sorted((str(r.page_id), r.host, r.verdict) for r in wider) == sorted((str(r.page_id), r.host, r.verdict) for r in rows)
