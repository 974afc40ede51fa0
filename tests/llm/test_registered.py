"""The registered queries: SQL where it can express them, the pipeline against plain steps."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import digest, duck, duck_rows, spark_rows

import __spark_entry__ as E
import corpus_pipeline
from llm_fixtures import odd_docs  # noqa: F401

from spendlens.llm import bpe, secrets
from spendlens.llm.decontaminate import normal_words
from spendlens.llm.oracle import ORACLE_SQL
from spendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    assert digest(*spark_rows(QUERIES[name](spark, SF))) == digest(*duck_rows(con, ORACLE_SQL[name]))


def test_pipeline_stage_by_stage(spark, con):
    """Each stage's effect on its own input: which rows stay, and what becomes of the texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "byte_bpe"]
    seen = {"documents": {r.doc_id: r for r in docs.collect()}}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in seen[name].values())
    before, clean, first, decon, safe, ids = (seen[k] for k in ("documents", *names))

    kept = {i for i, *_, k in duck_rows(con, ORACLE_SQL["op5_quality_rules"])[1] if k}
    assert set(clean) == kept
    for i, r in clean.items():
        lines = before[i].text.split("\n")
        assert r.text == before[i].text or all(x in lines for x in r.text.split("\n"))

    sets = {i: _shingles(r.text) for i, r in clean.items()}
    for i in set(clean) - set(first):  # gone: some document before it, kept or not, is alike
        assert any(_alike(sets[i], sets[j]) for j in sets if j < i), i
    left = sorted(first)
    assert not any(_alike(sets[a], sets[b]) for k, a in enumerate(left) for b in left[:k])

    items = [normal_words((r.text or "").encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 13]) for w in items for i in range(max(1, len(w) - 12)) if w}
    for i, r in first.items():
        w = normal_words(r.text.encode())
        hit = {k + j for n in {len(x) for x in windows} for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for j in range(n)}
        assert (i in decon) == (not hit or 20 * len(hit) < len(w))
        if i in decon and not hit:
            assert decon[i].text == r.text

    assert set(safe) == set(decon)
    for i, r in decon.items():
        base = secrets.base_spans(r.text)
        assert not secrets.base_spans(safe[i].text)
        if not base and "[SECRET]" not in safe[i].text:
            assert safe[i].text == r.text

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    judge = tiktoken.Encoding("judge", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(ids) == set(safe)
    for i, r in ids.items():
        own = np.array(judge.encode_ordinary(safe[i].text), "<u4").tobytes()
        assert bytes(r.token_ids) == own and r.n_tokens == len(own) // 4
        assert r.decoded_sha256 == hashlib.sha256(safe[i].text.encode()).hexdigest()


def _shingles(text):
    w = normal_words(text.encode())
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def _alike(a, b):
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    n = len(a & b)
    return 5 * n >= 4 * (len(a) + len(b) - n)


def test_stages_take_odd_rows(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, SF)
            assert name == "byte_bpe" or out.columns == docs.columns
            assert out.count() <= some.count()


def test_stages_on_repeated_rows_ties_and_clashing_columns(spark):
    """What each stage does with rows that repeat, copies of several ids, null ids and columns named as its own."""
    words = " ".join(f"word{i} of{i % 7} line" for i in range(60))
    other = " ".join(f"other{i} thing{i % 5} here" for i in range(60))
    rows = [(5, words), (5, words), (9, words), (None, words), (7, other), (8, None), (6, ""), (None, other + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "'x' AS _row", "1 AS _text", "2 AS spans", "'q' AS kept", "3 AS _key"
    )
    by = dict(corpus_pipeline.STAGES)
    left = lambda name: sorted(str(r.doc_id) for r in by[name](spark, docs, SF).collect())
    assert left("quality_rules") == ["5", "5", "7", "9", "None", "None"]
    assert left("near_dedup") == ["5", "5", "6", "7", "8"]  # the tailed text is a near copy of 7
    assert left("decontamination") == left("secret_scan") == left("byte_bpe") == sorted(str(i) for i, _ in rows)
    for name in ("quality_rules", "near_dedup", "decontamination", "secret_scan"):
        out = by[name](spark, docs, SF)
        assert out.columns == docs.columns
        assert {(r._row, r._text, r.spans, r.kept, r._key) for r in out.collect()} == {("x", 1, 2, "q", 3)}
