"""Members in buckets of their clean email: no shuffle on their side, the same rows."""

from __future__ import annotations

import pytest

from idbridge.operators import MemberIndex, SkewPolicy, hot_from_sketches, key_sketch, match
from idbridge.plans import catalog
from idbridge.plans.pipelines import AssociationRepair, TicketOrphans, TransactionOrphans, UserMapping
from idbridge.sources import FixtureTables
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def shuffled(spark):
    """Every table too large to broadcast, plans as they are before adaptive changes."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _chains(plan, names):
    """For each scan of a bucketed table: the operators from the scan up to its first join."""
    out = []

    def walk(node, above):
        name = node.nodeName()
        children = node.children()
        if name.startswith("Scan parquet") and "Bucketed: true" in node.toString():
            out.append([a for a in above])
        below = [] if "Join" in name else [*above, name]
        for i in range(children.size()):
            walk(children.apply(i), below)

    walk(plan, [])
    return out


def _jobs(spark, index):
    t = FixtureTables(SF_SMALL)
    p1 = UserMapping.from_tables(spark, t, t, index=index)
    p2 = AssociationRepair.from_tables(spark, t, index=index)
    p3 = TransactionOrphans.from_tables(spark, t, catalog.TEST_MIN_YEAR, index=index)
    p4 = TicketOrphans.from_tables(spark, t, t, index=index)
    return {"p1 mapped": p1.mapped, "p1 update": p1.update().table, "p1 stable": p1.update(stable=True).table,
            "p2 transactions": p2.remap_transactions, "p2 reservations": p2.remap_reservations,
            "p2 invoices": p2.remap_invoices(cascade=True), "p2 update": p2.update_transactions().table,
            "p2 update reservations": p2.update_reservations().table,
            "p3 unmatched": p3.unmatched, "p3 matched": p3.matched, "p4 unmatched": p4.unmatched, "p4 matched": p4.matched,
            "p4 inserts": p4.inserts.select("email", "name", "external_id")}


def test_rows_equal_those_without_the_index(spark):
    index = catalog.member_index(spark, SF_SMALL)
    plain = _jobs(spark, None)
    for name, df in _jobs(spark, index).items():
        assert df.columns == plain[name].columns
        assert rows(df) == rows(plain[name]), name


def test_members_are_not_shuffled(spark, shuffled):
    index = catalog.member_index(spark, SF_SMALL)
    for name, df in _jobs(spark, index).items():
        if name == "p1 stable":  # reads the ids that a user may keep as well, by key and value
            continue
        chains = _chains(df._jdf.queryExecution().executedPlan(), name)
        assert chains, name
        assert all("Exchange" not in op for chain in chains for op in chain), (name, chains)


def test_without_the_index_they_are(spark, shuffled):
    plan = _jobs(spark, None)["p1 mapped"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_null_matches_null_only_where_asked(spark, scratch):
    members = spark.createDataFrame([("M1", " A@x"), ("M2", None), ("M3", ""), ("M4", "a@X"), (None, "a@x")],
                                    "id string, email string")
    index = MemberIndex.build(members, "idx_nulls", 4, scratch)
    left = spark.createDataFrame([(1, "a@x"), (2, None), (3, ""), (4, "q")], "id long, email string")
    assert rows(index.match(left, "email", "inner")) == [
        (1, "a@x", "M1"), (1, "a@x", "M4"), (1, "a@x", None), (2, None, "M2"), (3, "", "M3")]
    assert rows(index.match(left, "email", "inner", null_safe=False)) == [
        (1, "a@x", "M1"), (1, "a@x", "M4"), (1, "a@x", None), (3, "", "M3")]
    assert rows(index.match(left, "email", "left_anti")) == [(4, "q")]
    assert rows(index.clean_members) == [("M1", "a@x"), ("M2", None), ("M3", ""), ("M4", "a@x"), (None, "a@x")]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_further_hot_keys_are_matched_apart(spark, scratch, how):
    members = spark.createDataFrame([(f"M{i}", "hot@x") for i in range(9)] + [("A", "a@x"), ("N", None), ("E", "")],
                                    "id string, email string")
    left = spark.createDataFrame([(i, "hot@x") for i in range(50)] + [(60, "a@x"), (61, None), (62, ""), (63, "q"), (64, "lone")]
                                 + [(i, "lone") for i in range(70, 90)], "id long, email string")
    index = MemberIndex.build(members, f"idx_hot_{how}", 4, scratch)
    policy = SkewPolicy(hot_rows=5, rows_per_split=4)
    hot = hot_from_sketches(key_sketch(left, "email"), key_sketch(members, "email"), policy)
    plain = index.match(left, "email", how)
    split = index.match(left, "email", how, hot=hot)
    assert split.columns == plain.columns and rows(split) == rows(plain)
    assert rows(split) == rows(match(left, index.clean_members, "email", how=how))


def test_rebuilt_index_replaces_the_old_one(spark, scratch):
    one = spark.createDataFrame([("M1", "a@x")], "id string, email string")
    two = spark.createDataFrame([("M2", "b@x"), ("M3", None)], "id string, email string")
    MemberIndex.build(one, "idx_again", 4, f"{scratch}/one")
    index = MemberIndex.build(two, "idx_again", 4, f"{scratch}/two")
    assert rows(index.clean_members) == [("M2", "b@x"), ("M3", None)]


def test_empty_members(spark, scratch):
    index = MemberIndex.build(spark.createDataFrame([], "id string, email string"), "idx_empty", 4, scratch)
    left = spark.createDataFrame([(1, "a"), (2, None)], "id long, email string")
    assert rows(index.match(left, "email", "left")) == [(1, "a", None), (2, None, None)]
