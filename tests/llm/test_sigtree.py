from __future__ import annotations

import random

import numpy as np
import pytest

from idbridge.llm import sigtree
from idbridge.llm.sigtree import Join, grow, jaccard_join, traverse
from idbridge.llm.store import Store

from . import helpers as h


def _run(spark, docs, **p):
    return jaccard_join(docs, Store(spark, "t"), Join(**p)).collect()


def _families(rng: random.Random) -> dict:
    """Edited copies around base texts, and a passage that all the others share."""
    texts, passage = [], h.words(40, rng)
    for _ in range(6):
        base = h.words(rng.randint(12, 160), rng)
        texts += [" ".join(h.edited(base, rng.choice([0, 0.005, 0.01, 0.02, 0.04, 0.06]), rng)) for _ in range(40)]
    texts += [" ".join(h.words(rng.randint(5, 60), rng) + passage + h.words(20, rng)) for _ in range(60)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return dict(zip(ids, texts, strict=True))


@pytest.mark.parametrize("k", [1, 5])
def test_families_of_edited_copies(spark, k):
    texts = _families(random.Random(12))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], h.DOC_SCHEMA)
    want = h.near_components(texts, k)
    for block, cell in ((512, 4096), (4, 8)):  # large trees in blocks, small ones together
        got = {r.doc_id: r.component_id for r in _run(spark, docs, shingle=k, block=block, cell=cell)}
        assert got == want


def test_any_order_of_shingles_is_exact(spark, monkeypatch):
    texts = _families(random.Random(13))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], h.DOC_SCHEMA)
    monkeypatch.setattr(sigtree, "FREQUENT", 7)
    assert {r.doc_id: r.component_id for r in _run(spark, docs)} == h.near_components(texts, 5)


def test_traversal_loses_no_link():
    """Leaf pairs left by trees of any height hold all links, and prune others."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2**63, rng.integers(40, 60), dtype=np.uint64)
        sets += [np.unique(np.where(rng.random(len(base)) < 0.05, rng.integers(0, 2**63, len(base), dtype=np.uint64), base))
                 for _ in range(10)]
    bits = []
    for s in sets:
        row = np.zeros(256, bool)
        row[(s & np.uint64(255)).astype(int)] = True
        bits.append(np.packbits(row, bitorder="little").view(np.uint64))
    size = np.array([len(s) for s in sets])
    links = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    for fan, height in ((2, 7), (16, 2), (200, 1)):
        levels = grow(np.stack(bits), size, np.zeros(len(sets), int), np.arange(len(sets)), fan, height)
        i, j, _ = traverse(levels, None, 80)
        left = set(zip(i.tolist(), j.tolist(), strict=True))
        assert links <= left and len(left) < 3 * len(links)


def test_edge_rows(spark):
    docs = h.edge_docs(spark)
    got = _run(spark, docs)
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[0] == [(0, 0)] and by[1] == [(0, 1)] and by[2] == [(0, 2)]
    assert {c for i in (6, 7, 8, 9) for _, c in by[i]} == {6}
    assert by[13] == [(1, 13)] and (1, 13) in by[None] and (1, None) in by[None]
    assert len(by[6]) == 3


def test_equal_polynomial_hashes_do_not_link(spark):
    """Two words whose polynomial hashes modulo 2**64 agree in any base."""
    word, other = h.twins()
    docs = spark.createDataFrame([(1, word, "en", "s", 0), (2, other, "en", "s", 0)], h.DOC_SCHEMA)
    assert sorted((r.doc_id, r.component_id) for r in _run(spark, docs)) == [(1, 1), (2, 2)]


def test_exact_threshold(spark):
    w = [f"w{i}" for i in range(200)]
    texts = [w[:13], w[:12], w[100:114], w[100:112], w[150:163], w[150:161]]  # 8/9, 8/10, 7/9
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)], h.DOC_SCHEMA)
    assert [r.component_id for r in sorted(_run(spark, docs), key=lambda r: r.doc_id)] == [0, 0, 2, 2, 4, 5]


def test_empty_table(spark):
    assert _run(spark, h.empty_docs(spark)) == []
