from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from idbridge.llm.langid import identify
from idbridge.llm.queries import vocabulary
from idbridge.llm.store import held_out

from . import helpers as h
from .test_exact import _norm
from ..conftest import SF_SMALL


def _after_language(spark, docs):
    """The first stage's decisions are the operator's; see test_langid."""
    found = identify(docs, ~held_out(F.col("doc_id")))
    return {r.doc_id: r.text for r in found.where("lang_pred != 'und'").collect()}


def test_run_against_plain_python(spark):
    tokenizers = pytest.importorskip("tokenizers")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    texts = _after_language(spark, docs)
    first: dict = {}
    for i in sorted(texts):
        first.setdefault(_norm(texts[i]), i)
    texts = {i: texts[i] for i in first.values()}
    near = h.near_components(texts, 5)
    texts = {i: t for i, t in texts.items() if near[i] == i}
    wins = set()
    for item in items:
        b = h.bench_words(item)
        m = min(10, len(b))
        wins |= {tuple(b[i:i + m]) for i in range(len(b) - m + 1)} if b else set()
    lengths = {len(w) for w in wins}

    def clean(text):
        w = h.bench_words(text)
        return not any(tuple(w[i:i + m]) in wins for m in lengths for i in range(len(w) - m + 1))

    texts = {i: t for i, t in texts.items() if clean(t)}
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary())
    got = {r.doc_id: r for r in cp.run(spark, SF_SMALL).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert got[i].ids == tokenizer.encode(t, add_special_tokens=False).ids
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages(spark):
    assert len(cp.STAGES) == 5
    docs = h.edge_docs(spark)
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF_SMALL)
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        got = out.collect()
        assert len(got) <= docs.count()
        assert stage(spark, h.empty_docs(spark), SF_SMALL).count() == 0
    assert len(got) == docs.count()  # the last stage drops nothing


def test_clean_documents_stay(spark):
    rng = __import__("random").Random(21)
    rows = [(i, " ".join(h.words(rng.randint(20, 200), rng)), "en", "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, h.DOC_SCHEMA)
    for _, stage in cp.STAGES[:-1]:
        assert sorted(r.doc_id for r in stage(spark, docs, SF_SMALL).collect()) == list(range(60))


def test_documents_stay_where_nothing_can_be_learned(spark):
    rows = [(1, "some words", None, "s", 0), (2, "слова", None, "s", 0), (3, "12 - 3", None, "s", 0), (4, None, None, "s", 0)]
    out = cp.language(spark, spark.createDataFrame(rows, h.DOC_SCHEMA), SF_SMALL).collect()
    assert sorted((r.doc_id, r.lang) for r in out) == [(1, None), (2, None)]


def test_predicted_language_fills_the_missing_one(spark):
    rows = [(i, "the quick brown fox " * (i % 5 + 1) if i % 2 else "щука рыба " * (i % 5 + 1),
             None if i >= 60 else "en" if i % 2 else "ru", "s", 0) for i in range(80)]
    out = cp.language(spark, spark.createDataFrame(rows, h.DOC_SCHEMA), SF_SMALL).collect()
    assert len(out) == 80 and all(r.lang == ("en" if r.doc_id % 2 else "ru") for r in out)
