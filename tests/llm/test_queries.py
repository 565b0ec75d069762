"""Registered queries against their SQL, and the pipeline against its stages' plain results, on the smallest tables."""

from __future__ import annotations

import importlib.util
import re
import sys
from itertools import combinations
from pathlib import Path

import duckdb
import pandas as pd
import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path.insert(0, str(ROOT))

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from obsloom.llm import quality
from obsloom.llm.queries import vocabulary_path

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables absent")
_spec = importlib.util.spec_from_file_location("compare", ROOT / "tools" / "compare.py")
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)


@pytest.mark.parametrize("name", ["op5_line_dedup", "op6_quality_rules", "op7_url_filter", "op8_mix_sources"])
def test_query_equals_its_sql(spark, name):
    assert compare.difference(queries()[name](spark, SF_DIR), compare.connect(SF_DIR).sql(oracle_sql()[name])) is None


def test_all_eleven_are_registered():
    names = queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def plain_lines(text: str) -> str:
    """The text without the lines that the quality rules remove, written down once more."""
    kept, seen = [], set()
    for line in text.split("\n"):
        n = len(line.encode().split())
        bad = n > 0 and (
            line in seen
            or (line.rstrip(" \t\n\x0b\x0c\r")[-1] not in quality.TERMINAL and quality.SENTENCE_WORDS * sum(c in quality.SENTENCE_ENDS for c in line) < n)
            or 4 * len(re.findall(quality.MARKS, line)) > n
            or 4 * sum(c in quality.SEPARATORS for c in line) > n
            or (n <= quality.PHRASE_WORDS and any(p in line.lower() for p in quality.PHRASES))
        )
        if n:
            seen.add(line)
        if not bad:
            kept.append(line)
    return "\n".join(kept)


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_pipeline_equals_plain_stages(spark):
    """SQL for the stages that have it, all pairs for near duplicates, the library for the tokenizer."""
    from tokenizers import Tokenizer

    con = duckdb.connect()

    def sql(statement, docs):
        con.register("documents", docs)
        out = con.sql(statement).df()
        con.unregister("documents")
        return out

    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    judged = sql(oracle_sql()["op6_quality_rules"], docs)
    docs = docs[docs.doc_id.isin(judged.doc_id[judged.kept])].copy()
    docs["text"] = docs.text.map(plain_lines)
    kept = sql(oracle_sql()["op5_line_dedup"].replace("sha256(coalesce(string_agg", "(coalesce(string_agg"), docs)
    docs["text"] = docs.doc_id.map(dict(zip(kept.doc_id, kept.kept_sha256, strict=True)))
    sets, gone = {i: shingles(t) for i, t in zip(docs.doc_id, docs.text, strict=True)}, set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
            gone |= {y} if x != y else set()
    docs = docs[~docs.doc_id.isin(gone)]
    mixed = sql(oracle_sql()["op8_mix_sources"], docs)
    docs = docs[docs.doc_id.isin(mixed.doc_id[mixed.kept])]
    library = Tokenizer.from_file(vocabulary_path())
    want = {i: (t, len(t), library.encode(t, add_special_tokens=False).ids) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["ids"]) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == want and len(want) > 50
