"""Nulls, empty and long texts, repeats, empty tables and clashing names, for every operator and stage."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from corpus_fixtures import odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline
from obsloom.llm.bpe import encode
from obsloom.llm.chaining import fuzzy_passages
from obsloom.llm.lines import dedup_lines
from obsloom.llm.lm import lm_scores
from obsloom.llm.minhash import near_duplicates
from obsloom.llm.mixing import annotated, mix
from obsloom.llm.quality import quality_rules
from obsloom.llm.queries import URL_RULES, vocabulary_path
from obsloom.llm.suffix import repeated_substrings
from obsloom.llm.urls import filter_urls
from obsloom.llm.vectors import near_vectors

DOCS = "doc_id long, text string, source string, lang string, n_chars long, kept string"
OPERATORS = {
    "lm": lambda d: lm_scores(d, vocabulary_path("byte_bpe_50k.tiktoken"), least_steps=2),
    "minhash": near_duplicates,
    "bpe": lambda d: encode(d, vocabulary_path(), decoded=True),
    "lines": dedup_lines,
    "quality": quality_rules,
    "mixing": lambda d: mix(annotated(d)),
    "suffix": repeated_substrings,
    "chaining": fuzzy_passages,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd_rows, name):
    rows = OPERATORS[name](spark.createDataFrame(odd_rows, DOCS)).collect()
    assert len(rows) == len(odd_rows)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by[5]) == 2 and by[5][0] == by[5][1]
    assert len(by[None]) == 2
    if name == "lm":
        assert by[1][0]["n_tokens"] == by[2][0]["n_tokens"] == 1
    if name == "minhash":
        assert by[1][0]["n_shingles"] == 0 and by[1][0]["kept"]
        assert by[4][0]["component_id"] == 3 and not by[4][0]["kept"]
        assert all(r["component_id"] is None and r["kept"] for r in by[None])
        assert by[5][0]["component_id"] == 5 and by[5][0]["kept"]
    if name == "bpe":
        assert all(r["decoded"] == (r["text"] or "") for r in rows) and by[1][0]["ids"] == []
    if name == "lines":
        assert all(r["n_dropped"] == 0 for r in rows) and by[2][0]["n_lines"] == 1 and by[6][0]["n_lines"] == 2
    if name == "quality":
        assert not by[1][0]["kept"] and by[1][0]["n_words"] == 0 and isinstance(by[3][0]["kept"], bool)
    if name == "mixing":
        assert by[1][0]["n_tokens"] == 0 and isinstance(by[1][0]["kept"], bool)
    if name == "suffix":
        assert by[3][0]["n_removed"] == by[3][0]["n_bytes"] == by[4][0]["n_removed"]
        assert by[7][0]["n_removed"] == 5000 and by[1][0]["n_bytes"] == 0
    if name == "chaining":
        assert by[3][0]["n_removed"] == 0 and by[4][0]["n_removed"] == 30_000 and by[4][0]["first_docs"] == [3]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], DOCS)).collect() == []


def test_other_tables(spark):
    schema = "page_id long, url string, host string, score int"
    rows = [(1, None, "h", 1), (None, "no scheme", None, None), (2, "http://example.org/es/x?y#z", "h", 2), (2, "http://example.org/es/x?y#z", "h", 2),
            (3, "HTTP://WWW.Example.ORG:80/", "h", 3), (4, "x" * 20_000, "h", 4), (5, "https://a.com/fr/q", "", 0), (6, "https://fr.com/de/", "", 0)]
    got = {r["page_id"]: r for r in filter_urls(spark.createDataFrame(rows, schema), URL_RULES).collect()}
    assert len(got) == 7 and got[1]["host"] == got[1]["path"] == "" and got[None]["host"] == ""
    assert (got[2]["host"], got[2]["path"], got[2]["rule"], got[2]["verdict"]) == ("example.org", "/es/x", "example.org/es/", "block")
    assert got[3]["host"] == "www.example.org:80" and got[3]["rule"] is None
    assert (got[5]["rule"], got[6]["rule"]) == ("com/fr/", "com/de/")
    assert filter_urls(spark.createDataFrame([], schema), URL_RULES).collect() == []

    schema = "vec_id long, embedding array<float>, label int, kept string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (3, [1.0, 0.0], 1, None), (4, [1.0, 0.0], 2, None), (5, [1.0, 0.0], None, None), (6, None, 1, None),
            (7, [0.0, 0.0], 1, None), (8, [nan, 1.0], 1, None), (9, [inf, 1.0], 1, None), (10, [None, 1.0], 1, None), (11, [], 1, None), (12, [1.0], 1, None),
            (None, [1.0, 0.0], 1, None), (3, [1.0, 0.0], 1, None), (13, [3.0e38, 1.0e38], 1, None), (14, [3.0, 1.0], 1, None), (None, None, None, None)]
    got = near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: r for r in got}
    # 1, 2 and both rows 3 point one way; 13 and 14 another, at a cosine of 0.949 to the first.
    assert [by[i]["n_links"] for i in (1, 2, 3, 13, 14)] == [5] * 5 and {by[i]["component_id"] for i in (1, 2, 3, 13, 14)} == {1}
    assert all(by[i]["n_links"] == 0 and by[i]["component_id"] == i and by[i]["kept"] for i in range(4, 13))
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert near_vectors(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages(spark, odd_rows, stage):
    docs = spark.createDataFrame(odd_rows, DOCS)
    for d in (docs, docs.where(F.lit(False))):
        out = stage[1](spark, d, "")
        if stage is not corpus_pipeline.STAGES[-1]:
            assert out.dtypes == d.dtypes
        out.collect()
