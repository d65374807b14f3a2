from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from idbridge.operators import Ledger, duplicate_rows
from tests.conftest import rows

SCHEMA = "id long, email string"


def _ledger(spark, root, **kw):
    return Ledger(spark, root, {"email": F.col("email")}, **kw)


def _counts(ledger):
    return {r.email: r.n for r in ledger.totals().collect()}


def test_random_batches_in_any_order_equal_a_recount(spark, scratch):
    rng = random.Random(4)
    table: dict[int, str | None] = {}
    batches, n = [], 0
    for _ in range(6):
        gone = rng.sample(sorted(table), min(len(table), rng.randint(0, 6)))
        deleted = [(i, table.pop(i)) for i in gone]
        inserted = []
        for _ in range(rng.randint(1, 12)):
            table[n] = rng.choice(["a", "b", "", None, f"u{n}"])
            inserted.append((n, table[n]))
            n += 1
        batches.append((inserted, deleted))
    ledger = _ledger(spark, scratch)
    order = [*range(6), 2, 4]  # two are booked twice
    rng.shuffle(order)
    for step, b in enumerate(order):
        inserted, deleted = (spark.createDataFrame(x, SCHEMA) for x in batches[b])
        ledger.commit(b, inserted, deleted)
        if step in (2, 5):
            ledger.compact()
    want = Counter(table.values())
    assert _counts(ledger) == want
    ledger.compact()
    assert _counts(ledger) == want
    members = spark.createDataFrame(list(table.items()), SCHEMA)
    assert rows(duplicate_rows(members, "email", counts=ledger.totals())) == rows(duplicate_rows(members, "email"))


def test_a_batch_said_again_replaces_what_it_said(spark, scratch):
    ledger = _ledger(spark, scratch)
    ledger.commit(2, spark.createDataFrame([(1, "b")], SCHEMA))
    ledger.commit(1, spark.createDataFrame([(1, "a"), (2, "a")], SCHEMA))
    ledger.commit(1, spark.createDataFrame([(1, "a")], SCHEMA))  # corrected after batch 2
    assert _counts(ledger) == {"a": 1, "b": 1}
    ledger.compact()
    assert not ledger.commit(1, spark.createDataFrame([(9, "z")], SCHEMA))  # closed
    assert _counts(ledger) == {"a": 1, "b": 1}


def test_a_batch_not_written_to_the_end_does_not_count(spark, scratch):
    ledger = _ledger(spark, scratch)
    ledger.commit(1, spark.createDataFrame([(1, "a")], SCHEMA))
    spark.createDataFrame([("b", 5)], "email string, n long").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{scratch}/batches/batch=2/v00000001-dead")
    spark.createDataFrame([("a", 5)], "email string, n long").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{scratch}/batches/batch=1/v00000002-dead")
    assert _counts(ledger) == {"a": 1}


def test_measures_without_keys(spark, scratch):
    ledger = Ledger(spark, scratch, {}, {"total": F.lit(1), "matched": F.when(F.col("email").isNotNull(), 1).otherwise(0)})
    ledger.commit("a", spark.createDataFrame([(1, "x"), (2, None)], SCHEMA))
    ledger.commit("b", deleted=spark.createDataFrame([(2, None)], SCHEMA), inserted=spark.createDataFrame([(2, "y")], SCHEMA))
    assert rows(ledger.totals()) == [(2, 2)]


def test_empty_batches(spark, scratch):
    ledger = _ledger(spark, scratch)
    with pytest.raises(ValueError):
        ledger.totals()
    with pytest.raises(ValueError):
        ledger.commit(1)
    ledger.commit(1, spark.createDataFrame([], SCHEMA))
    assert _counts(ledger) == {}


def test_totals_read_the_batches_only(spark, scratch):
    """A report reads one row per key of a batch, not the rows it came from."""
    ledger = _ledger(spark, scratch)
    ledger.commit(1, spark.range(5000).select("id", F.concat(F.lit("k"), F.col("id") % 10).alias("email")))
    ledger.compact()
    assert ledger.totals().inputFiles() and spark.read.parquet(*ledger.totals().inputFiles()).count() == 10
