from __future__ import annotations

from idbridge.operators import duplicate_rows, key_counts, mapping_summary, row_count
from tests.conftest import rows


def test_duplicate_rows_keeps_every_row_of_groups_over_one(spark):
    df = spark.createDataFrame(
        [("M1", "a@x"), ("M2", "a@x"), ("M3", None), ("M4", None), ("M5", "b@x"), ("M6", "")],
        "member_id string, email string")
    out = duplicate_rows(df, "email")
    assert out.columns == ["member_id", "email"]
    got = [tuple(r) for r in out.collect()]
    # sorted by email ascending with NULL last, then the other columns
    assert got == [("M1", "a@x"), ("M2", "a@x"), ("M3", None), ("M4", None)]


def test_duplicate_rows_empty_when_unique(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, email string")
    assert duplicate_rows(df, "email").count() == 0


def test_key_counts_having(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "email string")
    assert rows(key_counts(df, "email")) == sorted([("a", 2), (None, 3)], key=repr)
    assert key_counts(df, "email").columns == ["email", "n"]


def test_mapping_summary_and_row_count(spark):
    df = spark.createDataFrame([(1, "M1"), (2, None), (3, "M3")], "id long, hn_member_id string")
    s = mapping_summary(df).first()
    assert (s.total_users, s.matched_users, s.missing_ids) == (3, 2, 1)
    assert dict(mapping_summary(df).dtypes) == {"total_users": "bigint", "matched_users": "bigint",
                                                "missing_ids": "bigint"}
    assert row_count(df).first()[0] == 3
