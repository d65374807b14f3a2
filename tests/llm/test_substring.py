from __future__ import annotations

import random
from collections import Counter

from idbridge.llm.store import Store
from idbridge.llm.substring import Cover, repeated_spans, without_repeats

from . import helpers as h


def brute(texts, k):
    all_words = [h.space_words(t) for t in texts]
    seen = Counter(tuple(w[i:i + k]) for w in all_words for i in range(len(w) - k + 1))
    out = []
    for w in all_words:
        gone = {p for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for p in range(i, i + k)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def _check(spark, docs, p):
    got = without_repeats(docs, repeated_spans(docs, Store(spark, "t"), p), p).collect()
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows], p.window), strict=True)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    return want


def test_shared_passages_at_all_shifts(spark):
    rng = random.Random(9)
    passages = [h.words(n, rng) for n in (34, 35, 36, 40, 47, 60, 200)]
    texts = []
    for n in range(150):
        w = h.words(rng.randint(0, 90), rng)
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            w = w[:rng.randint(0, len(w))] + p[a:] + w
        texts.append(rng.choice([" ", "\n", "  \t"]).join(w))
    texts.append(" ".join(["again"] * 50))  # windows that overlap themselves
    texts += texts[:5]  # whole texts that occur twice
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], h.DOC_SCHEMA)
    want = _check(spark, docs, Cover())
    assert sum(w[2] > 0 for w in want) > 60
    _check(spark, docs, Cover(flush=50, bucket_bytes=1000))  # many buckets, entries sent in small lots
    _check(spark, docs, Cover(window=12, period=7, cover=(0, 1, 3)))


def test_edge_rows(spark):
    _check(spark, h.edge_docs(spark), Cover())


def test_empty_table(spark):
    _check(spark, h.empty_docs(spark), Cover())


def test_words_of_equal_polynomials_differ(spark):
    a, b = h.twins()
    w = [f"w{i}" for i in range(34)]
    texts = [" ".join([*w[:17], x, *w[17:]]) for x in (a, b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], h.DOC_SCHEMA)
    assert {r[2] for r in _check(spark, docs, Cover())} == {0}


def test_positions_of_a_copied_text_do_not_grow_with_the_tasks(spark):
    """One text in all rows: its repeated positions are held once, however many tasks send them."""
    rng = random.Random(5)
    text = " ".join(h.words(120, rng))
    docs = spark.createDataFrame([(i, text, "en", "s", 0) for i in range(64)], h.DOC_SCHEMA)
    sizes = set()
    for parts in (1, 8, 32):
        sent = docs.repartition(parts)
        _check(spark, sent, Cover())
        store = Store(spark, "t")
        repeated_spans(sent, store).count()
        tables = [d for d in spark._jvm.java.io.File(store.path.replace("file:", "")).list()]
        for name in tables:
            t = spark.read.parquet(f"{store.path}/{name}")
            if "pos" in t.columns and t.schema["pos"].dataType.typeName() == "array":
                sizes |= {(name, r.n) for r in t.selectExpr("size(pos) AS n").distinct().collect()}
    assert len({name for name, _ in sizes}) == len(sizes)
