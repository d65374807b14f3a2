from __future__ import annotations

import pytest

from idbridge.operators import match_anti, match_inner, match_left, match_semi
from tests.conftest import rows

USERS = [(1, "a@x"), (2, "b@x"), (3, None), (4, "z@x"), (5, "")]
MEMBERS = [("M1", "a@x"), ("M2", "a@x"), ("M3", None), ("M4", "b@x"), ("M5", "")]


@pytest.fixture()
def users(spark):
    return spark.createDataFrame(USERS, "id long, email string")


@pytest.fixture()
def members(spark):
    return spark.createDataFrame(MEMBERS, "member_id string, email string")


def test_left_join_null_safe_matches_null_and_fans_out(users, members):
    out = match_left(users, members, "email")
    assert out.columns == ["id", "email", "member_id"]
    assert rows(out) == sorted([(1, "a@x", "M1"), (1, "a@x", "M2"), (2, "b@x", "M4"), (3, None, "M3"),
                                (4, "z@x", None), (5, "", "M5")], key=repr)


def test_left_join_sql_style_null_matches_nothing(users, members):
    out = match_left(users, members, "email", null_safe=False)
    assert (3, None, None) in rows(out)
    # empty string is a value, not NULL
    assert (5, "", "M5") in rows(out)


def test_anti_join_null_safe_and_sql(users, members):
    assert rows(match_anti(users, members, "email")) == [(4, "z@x")]
    assert rows(match_anti(users, members, "email", null_safe=False)) == sorted([(3, None), (4, "z@x")], key=repr)


def test_anti_join_keeps_duplicate_left_rows(spark, members):
    left = spark.createDataFrame([("q@x",), ("q@x",), ("a@x",)], "customer_email string")
    out = match_anti(left, members, "customer_email", "email")
    assert rows(out) == [("q@x",), ("q@x",)]


def test_semi_join(users, members):
    assert [r[0] for r in rows(match_semi(users, members, "email"))] == [1, 2, 3, 5]


def test_inner_join_different_key_names_keeps_left_key(spark, members):
    orphans = spark.createDataFrame([("a@x",), (None,), ("none@x",)], "customer_email string")
    out = match_inner(members, orphans, "email", "customer_email")
    assert out.columns == ["member_id", "email"]
    assert rows(out) == sorted([("M1", "a@x"), ("M2", "a@x"), ("M3", None)], key=repr)


def test_column_clash_is_rejected(users, spark):
    other = spark.createDataFrame([(1, "a@x")], "id long, email string")
    with pytest.raises(ValueError):
        match_left(users, other, "email")


def test_numeric_key_null_safe(spark):
    inv = spark.createDataFrame([(10, 1), (11, None), (12, 0)], "invoice_id long, reservation_id long")
    resv = spark.createDataFrame([(1, "M1"), (None, "MN")], "reservation_id long, member_id string")
    out = match_left(inv, resv, "reservation_id")
    # NULL matches NULL; 0 (the key filler) does not match NULL
    assert rows(out) == sorted([(10, 1, "M1"), (11, None, "MN"), (12, 0, None)], key=repr)


def test_transaction_orphans_raw_and_collated(spark):
    import datetime as dt

    from idbridge.plans.orphans import transaction_orphans
    d = dt.datetime(2026, 3, 1)
    trans = spark.createDataFrame(
        [(1, "A@x", None, d), (2, "A@x", None, d), (3, "b@x", None, d), (4, "c@x", "M1", d),
         (5, None, None, d), (6, "d@x", None, dt.datetime(2025, 12, 31))],
        "id long, customer_email string, member_id string, date timestamp_ntz")
    members = spark.createDataFrame([("M1", "a@x"), ("M2", "b@x"), (None, "q@x")], "id string, email string")
    assert rows(transaction_orphans(trans, members, 2026)) == [("A@x",)]
    assert transaction_orphans(trans, members, 2026, collation="UTF8_LCASE").count() == 0
