"""Every registered query against its DuckDB oracle, and the pipeline invariants."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from idbridge.plans import catalog
from tests.conftest import SF_CHECK, SF_SMALL

TPCH = ("customer", "orders")


def _norm(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _bag(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module", params=[SF_SMALL, SF_CHECK], ids=["sf0.001", "sf0.01"])
def duck(request):
    con = duckdb.connect()
    for t in TPCH:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{request.param}/{t}.parquet')")
    yield request.param, con
    con.close()


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(queries())
    assert set(catalog.QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sf_dir, con = duck
    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, got) == _bag(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["id", "email", "member_id"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.exists(SF_CHECK), reason="no sf0.01 data")
def test_known_counts_at_sf001(spark):
    expect = {"mapped_users": 1506, "dup_members": 63, "dup_users": 51, "dup_mapped": 123,
              "member_email_counts": 31, "changed_users": 440, "changed_users_null_safe": 845,
              "remap_transactions": 16279, "changed_transactions": 5778, "changed_reservations": 1903,
              "changed_invoices": 10610, "changed_invoices_cascade": 12938, "transaction_orphans": 1100,
              "dup_transaction_orphans": 477, "unmatched_transaction_emails": 172,
              "matched_transaction_orphans": 941, "ticket_orphans": 515, "dup_ticket_orphans": 83,
              "unmatched_ticket_users": 82, "matched_ticket_orphans": 520, "new_members": 82}
    got = {n: queries()[n](spark, SF_CHECK).count() for n in expect}
    assert got == expect


def test_update_invariants(spark):
    p2 = catalog.p2(spark, SF_SMALL)
    for plan, base in [(p2.update_transactions(), p2.transactions), (p2.update_reservations(), p2.reservations),
                       (p2.update_invoices(), p2.invoices), (p2.update_invoices(cascade=True), p2.invoices)]:
        assert plan.table.count() == base.count()
        assert plan.table.select("id").subtract(base.select("id")).count() == 0
        assert plan.table.subtract(base).count() == plan.changes.count()


def test_insert_adds_exactly_the_unmatched(spark):
    p4 = catalog.p4(spark, SF_SMALL)
    assert p4.inserts.count() == p4.unmatched.count()
    # after the insert, every orphan email has a member
    from idbridge.operators import match_anti, preview_append
    from idbridge.plans.pipelines import clean_members
    after = preview_append(p4.members, p4.inserts)
    assert match_anti(p4.orphans, clean_members(after), "email").count() == 0


@pytest.fixture(scope="module")
def forced_split(spark):
    """Shuffle joins only, and tiny hot thresholds, so NULL and duplicate
    emails are split across parts in every join."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "idbridge.skew.hotRows": "3",
            "idbridge.skew.rowsPerSplit": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    con = duckdb.connect()
    for t in TPCH:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle_with_hot_keys_split(spark, forced_split, name):
    df = queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = forced_split.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _bag(df.columns, got) == _bag(ocols, res.fetchall())
