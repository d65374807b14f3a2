from __future__ import annotations

import pytest

from idbridge.operators import dedupe_inserts, member_inserts, preview_append, update_from_lookup
from idbridge.sources.schemas import MEMBER_INSERT
from tests.conftest import rows

# target rows: (id, email, current member id)
TARGET = [
    (1, "a@x", "M9"),    # candidates M1, M2 -> M1
    (2, "a@x", "M1"),    # current is the smallest candidate -> M2
    (3, "a@x", None),    # NULL current: sql guard skips, null-safe fills M1
    (4, "b@x", "M4"),    # only candidate equals current -> unchanged
    (5, "z@x", "M5"),    # no candidate -> unchanged
    (6, None, "M7"),     # NULL email matches the NULL-email member M6
    (7, None, None),
]
LOOKUP = [("M1", "a@x"), ("M2", "a@x"), ("M4", "b@x"), ("M6", None)]


@pytest.fixture()
def target(spark):
    return spark.createDataFrame(TARGET, "id long, email string, member_id string")


@pytest.fixture()
def lookup(spark):
    return spark.createDataFrame(LOOKUP, "mid string, email string")


def _update(target, lookup, **kw):
    return update_from_lookup(target, key="id", match_col="email", set_col="member_id",
                              lookup=lookup, lookup_col="email", value_col="mid", **kw)


def test_sql_guard(target, lookup):
    plan = _update(target, lookup, guard="sql")
    assert rows(plan.changes) == sorted([(1, "M9", "M1"), (2, "M1", "M2"), (6, "M7", "M6")], key=repr)
    new = dict(rows(plan.table, "id", "member_id"))
    assert new == {1: "M1", 2: "M2", 3: None, 4: "M4", 5: "M5", 6: "M6", 7: None}


def test_null_safe_guard(target, lookup):
    plan = _update(target, lookup, guard="null_safe")
    assert rows(plan.changes) == sorted(
        [(1, "M9", "M1"), (2, "M1", "M2"), (3, None, "M1"), (6, "M7", "M6"), (7, None, "M6")], key=repr)


def test_stable_skips_rows_already_on_a_candidate(target, lookup):
    plan = _update(target, lookup, guard="sql", stable=True)
    assert rows(plan.changes) == sorted([(1, "M9", "M1"), (6, "M7", "M6")], key=repr)


def test_sql_join_semantics_for_lookup(target, lookup):
    plan = _update(target, lookup, guard="null_safe", null_safe_match=False)
    assert 6 not in [r[0] for r in plan.changes.collect()]


def test_update_keeps_rows_keys_and_columns(target, lookup):
    plan = _update(target, lookup, guard="null_safe")
    assert plan.table.columns == target.columns
    assert plan.table.count() == target.count()
    assert rows(plan.table, "id", "email") == rows(target, "id", "email")
    # rows that differ from the target are exactly the changes
    diff = plan.table.subtract(target)
    assert diff.count() == plan.changes.count()


def test_rerun_as_written_can_flip_but_stable_does_not(target, lookup):
    once = _update(target, lookup, guard="sql").table
    twice = _update(once, lookup, guard="sql").table
    assert dict(rows(twice, "id", "member_id"))[1] == "M2"  # M1 -> M2: the flip the rule documents
    stable_once = _update(target, lookup, guard="sql", stable=True).table
    stable_twice = _update(stable_once, lookup, guard="sql", stable=True).table
    assert rows(stable_once) == rows(stable_twice)


def test_member_inserts_shape_and_constants(spark):
    unmatched = spark.createDataFrame(
        [(10, "p@x", "Ann", None, None), (11, None, None, None, None)],
        "user_id long, email string, fname string, lname string, created_at timestamp_ntz")
    out = member_inserts(unmatched)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in MEMBER_INSERT.fields]
    got = {r.external_id: r for r in out.collect()}
    assert got[10].name == "Ann NA" and got[11].name == "NA NA"
    assert got[10].email_verified == 0 and got[10].phone_number is None
    assert got[10].created_at == got[10].updated_at
    assert len({r.id for r in got.values()}) == 2


def test_member_inserts_stable_ids_and_dedupe(spark):
    unmatched = spark.createDataFrame(
        [(10, "p@x", "A", "B", None), (11, "p@x", "C", "D", None)],
        "user_id long, email string, fname string, lname string, created_at timestamp_ntz")
    a = rows(member_inserts(unmatched, id_mode="stable"), "id")
    b = rows(member_inserts(unmatched, id_mode="stable"), "id")
    assert a == b
    assert [r.external_id for r in dedupe_inserts(member_inserts(unmatched)).collect()] == [10]


def test_preview_append(spark):
    table = spark.createDataFrame([("M1", "a@x")], "id string, email string")
    new = spark.createDataFrame([("p@x", "M2")], "email string, id string")
    assert rows(preview_append(table, new)) == [("M1", "a@x"), ("M2", "p@x")]


def test_materialized_plan_gives_same_table_and_changes(target, lookup):
    plan = _update(target, lookup, guard="null_safe")
    m = plan.materialized()
    assert rows(m.table) == rows(plan.table)
    assert rows(m.changes) == rows(plan.changes)
    assert m.without("email").table.columns == ["id", "member_id"]


def test_dedupe_keeps_rows_without_email_apart(spark):
    from idbridge.operators import dedupe_inserts
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "external_id long, email string")
    assert rows(dedupe_inserts(df)) == [(1, None), (2, None), (3, "a")]


def test_member_row_without_id_does_not_hold_its_email(spark):
    """The source query joins members and keeps rows whose member id is NULL."""
    import datetime as dt

    from idbridge.plans.orphans import transaction_orphans
    day = dt.datetime(2026, 1, 1)
    trans = spark.createDataFrame([(i, e, None, day) for i, e in enumerate(["a", "b", "c", "d"])],
                                  "id long, customer_email string, member_id string, date timestamp_ntz")
    members = spark.createDataFrame([("M1", "a"), (None, "b"), ("M2", "c"), (None, "c")], "id string, email string")
    assert rows(transaction_orphans(trans, members, 2026)) == [("b",), ("c",), ("d",)]


def test_unique_lookup_gives_the_same_update(spark):
    from idbridge.operators import update_from_lookup
    target = spark.createDataFrame([(1, 10, "x"), (2, 11, None), (3, None, "y"), (4, 99, "z"), (5, 12, "w")],
                                   "id long, ref long, cur string")
    lookup = spark.createDataFrame([(10, "p"), (11, "q"), (12, None), (13, "r")], "ref long, v string")
    args = dict(key="id", match_col="ref", set_col="cur", lookup=lookup, lookup_col="ref", value_col="v")
    plain, unique = (update_from_lookup(target, **args, unique_lookup=u) for u in (False, True))
    assert rows(plain.table) == rows(unique.table)
    assert rows(plain.changes) == rows(unique.changes) == [(1, "x", "p"), (2, None, "q")]
