from __future__ import annotations

import hashlib
import re
import uuid

from idbridge.llm.exact import DigestIndex
from idbridge.llm.store import Store

from .helpers import DOC_SCHEMA, edge_docs, empty_docs


def _index(spark):
    return DigestIndex(spark, f"t_{uuid.uuid4().hex}", buckets=4)


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_edge_rows_against_brute_force(spark):
    docs = edge_docs(spark)
    index = _index(spark)
    got = index.add(docs, "one", Store(spark, "t")).collect()
    groups: dict = {}
    for r in docs.collect():
        groups.setdefault(_norm(r.text), []).append(r.doc_id)
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            want.append((i, hashlib.sha256(text.encode()).hexdigest(), min(known) if known else None, len(ids), False))
    assert sorted(((r.doc_id, bytes(r.digest).hex(), r.keep_id, r.group_size, r.seen) for r in got), key=repr) == \
        sorted(want, key=repr)
    index.drop()


def test_later_batches_are_checked_against_the_index(spark):
    index, store = _index(spark), Store(spark, "t")
    rows = lambda *r: spark.createDataFrame([(i, t, "en", "s", 0) for i, t in r], DOC_SCHEMA)
    assert index.add(rows((5, "a  b"), (7, "c")), "1", store).count() == 2
    second = rows((1, "a\tb"), (2, "d"), (3, "d"))
    kept = sorted(r.doc_id for r in index.keep_new(second, "2", store).collect())
    assert kept == [2]  # a b is known, the second d repeats
    got = {(r.doc_id, r.keep_id, r.seen) for r in index.add(second, "2", store).collect()}
    assert got == {(1, 5, True), (2, 2, False), (3, 2, False)}
    assert index.rows().count() == 3  # the batch was added twice
    plan = index.rows()._jdf.queryExecution().toString()
    assert "batch" in plan
    index.drop()


def test_index_is_not_shuffled(spark):
    index, store = _index(spark), Store(spark, "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index.add(edge_docs(spark), "1", store)
        new = spark.createDataFrame([(b"x",)], "digest binary")
        plan = new.hint("merge").join(index.rows().select("digest").hint("merge"), "digest", "left_anti")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        index.drop()


def test_empty_table(spark):
    index, store = _index(spark), Store(spark, "t")
    assert index.add(empty_docs(spark), "1", store).count() == 0
    assert index.keep_new(empty_docs(spark), "2", store).count() == 0
    index.drop()


def test_keep_new_keeps_all_columns_and_one_row_per_text(spark):
    docs, index = edge_docs(spark), _index(spark)
    kept = index.keep_new(docs, "1", Store(spark, "t"))
    assert kept.columns == docs.columns
    texts = [_norm(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({_norm(r.text) for r in docs.collect()})
    index.drop()
