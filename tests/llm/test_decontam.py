from __future__ import annotations

import random

from pyspark.sql import functions as F

from idbridge.llm.decontam import Winnow, contamination, words_hit
from idbridge.llm.store import Store

from . import helpers as h


def brute(text, items):
    w, hit, which = h.bench_words(text), set(), set()
    for item_id, item in items:
        b = h.bench_words(item)
        m = min(10, len(b))
        wins = {tuple(b[i:i + m]) for i in range(len(b) - m + 1)} if b else set()
        for i in range(len(w) - m + 1):
            if m and tuple(w[i:i + m]) in wins:
                hit |= set(range(i, i + m))
                if item_id is not None:
                    which.add(str(item_id))
    return len(w), len(hit), sorted(which)


def _check(spark, docs, items, **p):
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("key", F.lit(1))
    got = (contamination(docs, bench, Store(spark, "t"), Winnow(**p))
           .select("doc_id", "n_words", words_hit().alias("n_hit"), "items").collect())
    want = [(r.doc_id, *brute(r.text, items)) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    return want


def test_planted_spans_of_every_length(spark):
    rng = random.Random(2)
    items = [(i, " ".join(h.words(rng.randint(12, 50), rng))) for i in range(20)]
    items += [(20, " ".join(h.words(9, rng))), (21, "lone"), (22, ""), (23, None), (24, items[0][1]), (None, items[1][1]),
              (25, " ".join(h.words(5, rng)))]
    docs = []
    for n in range(120):
        text = h.words(rng.randint(0, 120), rng)
        for _ in range(rng.randint(0, 3)):
            b = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(b) - 8))
            k = rng.choice([8, 9, 10, 11, 15, 60])
            at = rng.randint(0, len(text))
            text[at:at] = b[a:a + k]
        sep = rng.choice([" ", ", ", "\n", " -- "])
        text = sep.join(text)
        docs.append((n, text.upper() if n % 7 == 0 else text, "en", "s", 0))
    docs = spark.createDataFrame(docs, h.DOC_SCHEMA)
    want = _check(spark, docs, items)
    assert sum(w[2] > 0 for w in want) > 20
    _check(spark, docs, items, broadcast_rows=0)  # the shuffled join


def test_edge_rows(spark):
    docs = h.edge_docs(spark)
    base = h.edge_texts()[6]
    _check(spark, docs, [(1, base), (2, " ".join(base.split()[20:33])), (3, "a b c"), (4, "word"), (5, None), (5, "x")])


def test_empty_tables(spark):
    _check(spark, h.empty_docs(spark), [(1, "a b c")])
    _check(spark, h.edge_docs(spark), [])


def test_words_of_equal_polynomials_differ(spark):
    a, b = h.twins()
    docs = spark.createDataFrame([(1, f"one {a} two", "en", "s", 0), (2, f"one {b} two", "en", "s", 0)], h.DOC_SCHEMA)
    _check(spark, docs, [(5, f"one {b} two")])
