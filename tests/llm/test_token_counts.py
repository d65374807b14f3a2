from __future__ import annotations

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from idbridge.llm.queries import QUERIES, vocabulary
from idbridge.llm.token_counts import TokenRollup

from ..conftest import SF_SMALL

SCHEMA = "op string, doc_id bigint, source string, lang string, tokenizer string, tokens bigint, chars bigint"


@pytest.fixture()
def rollup(spark):
    r = TokenRollup(spark, f"r_{uuid.uuid4().hex}")
    yield r
    r.drop()


def _totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in rollup.totals().collect()}


def brute(batches):
    """What the last batch that names a doc_id and tokenizer says."""
    state: dict = {}
    for batch in batches:
        new: dict = {}
        for op, doc, source, lang, tok, tokens, chars in batch:
            rows = new.setdefault((doc, tok), [])
            if op != "delete":
                rows.append(((source, lang, tok), tokens or 0, chars or 0))
        state.update(new)
    docs, tokens, chars = Counter(), Counter(), Counter()
    for rows in state.values():
        for key, t, c in rows:
            docs[key] += 1
            tokens[key] += t
            chars[key] += c
    return {k: (docs[k], tokens[k], chars[k]) for k in docs}


def _random_batches(rng):
    value = lambda *c: rng.choice(c)
    return [[(value("insert", "revise", "delete"), value(None, *range(30)), value("a", "b", None), value("en", None),
              value("v1", "v2"), value(None, 0, 5, 17), value(1, None, 9)) for _ in range(40)] for _ in range(4)]


def test_random_changes_against_replay(spark, rollup):
    batches = _random_batches(random.Random(8))
    for n, batch in enumerate(batches, 1):
        rollup.commit(n, spark.createDataFrame(batch, SCHEMA).withColumn("docs", F.lit("user")))
        assert _totals(rollup) == brute(batches[:n])


def test_a_batch_committed_again_changes_nothing(spark, rollup):
    batches = _random_batches(random.Random(9))
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    for n, frame in enumerate(frames, 1):
        rollup.commit(n, frame)
    want = _totals(rollup)
    for n, frame in enumerate(frames, 1):  # also out of turn
        rollup.commit(n, frame)
        assert _totals(rollup) == want


def test_a_half_done_commit_is_repaired(spark, rollup):
    first = spark.createDataFrame([("insert", 1, "a", "en", "v1", 10, 20), ("insert", 2, "a", "en", "v1", 1, 2)], SCHEMA)
    second = spark.createDataFrame([("revise", 1, "b", "en", "v1", 4, 20), ("delete", 2, None, None, "v1", 0, 0)], SCHEMA)
    rollup.commit(1, first)
    # the ledger of batch 2 is written, then the job dies before its deltas
    write, rollup._write = rollup._write, lambda df, table, batch: write(df, table, batch) if "ledger" in table else None
    rollup.commit(2, second)
    rollup._write = write
    assert _totals(rollup) == {("a", "en", "v1"): (2, 11, 22)}
    rollup.commit(2, second)
    assert _totals(rollup) == {("b", "en", "v1"): (1, 4, 20)}


def test_empty_batches(spark, rollup):
    rollup.commit(1, spark.createDataFrame([], SCHEMA))
    assert _totals(rollup) == {}


def test_query_against_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(vocabulary())
    want: dict = {}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        n = len(t.encode(r.text or "", add_special_tokens=False).ids)
        old = want.get((r.source, r.lang), (0, 0, 0))
        want[r.source, r.lang] = (old[0] + 1, old[1] + n, old[2] + len(r.text or ""))
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens, r.n_chars) for r in QUERIES["op6_token_counts"](spark, SF_SMALL).collect()}
    assert got == want


def test_late_changed_and_repeated_batches_against_replay(spark, rollup):
    rng = random.Random(18)
    batches = _random_batches(rng)
    said: dict = {}
    for n in (2, 4, 1, 3, 2, 1):  # late ones, and some again with other rows
        said[n] = batches.pop() if n not in said and batches else _random_batches(rng)[0]
        rollup.commit(n, spark.createDataFrame(said[n], SCHEMA))
        assert _totals(rollup) == brute([said[k] for k in sorted(said)])


def test_a_revision_before_its_insert_counts_one_document(spark, rollup):
    row = lambda op, tokens: spark.createDataFrame([(op, 1, "a", "en", "v1", tokens, 1)], SCHEMA)
    rollup.commit(2, row("revise", 7))
    rollup.commit(1, row("insert", 5))
    assert _totals(rollup) == {("a", "en", "v1"): (1, 7, 1)}
    rollup.commit(1, row("insert", 50))
    assert _totals(rollup) == {("a", "en", "v1"): (1, 7, 1)}
    rollup.commit(1, row("insert", 50).withColumn("doc_id", F.lit(2)))  # batch 1 names another document now
    assert _totals(rollup) == {("a", "en", "v1"): (2, 57, 2)}


def test_a_null_tokenizer_is_a_value(spark, rollup):
    row = lambda op, tokens: spark.createDataFrame([(op, 1, "a", "en", None, tokens, 1)], SCHEMA)
    rollup.commit(1, row("insert", 5))
    rollup.commit(2, row("revise", 7))
    assert _totals(rollup) == {("a", "en", None): (1, 7, 1)}
    rollup.commit(3, row("delete", 0))
    assert _totals(rollup) == {}
