from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from idbridge.functions import at_least_year, paste_names, sanitize_email, stable_member_id


def test_sanitize_email_strips_r_whitespace_and_lowercases(spark):
    df = spark.createDataFrame(
        [("  A@B.Test\r\n",), ("\tx@y.test",), ("UP@X.TEST ",), (None,), ("   ",), ("a b@c.test",)],
        "e string")
    got = [r[0] for r in df.select(sanitize_email("e")).collect()]
    assert got == ["a@b.test", "x@y.test", "up@x.test", None, "", "a b@c.test"]


def test_sanitize_email_keeps_inner_and_other_whitespace(spark):
    # only space, tab, CR and LF are stripped, and only at the ends
    df = spark.createDataFrame([(" a@b.test\x0b",), (" a\tb@c.test ",)], "e string")
    got = [r[0] for r in df.select(sanitize_email("e")).collect()]
    assert got == [" a@b.test\x0b", "a\tb@c.test"]


def test_sanitize_email_casts_non_string(spark):
    df = spark.createDataFrame([(12,)], "e int")
    assert df.select(sanitize_email("e")).first()[0] == "12"


def test_paste_names_writes_na_like_r(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee"), ("Ann", None), (None, None)], "f string, l string")
    got = [r[0] for r in df.select(paste_names("f", "l")).collect()]
    assert got == ["Ann Lee", "NA Lee", "Ann NA", "NA NA"]


def test_paste_names_can_skip_missing(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee"), (None, None)], "f string, l string")
    got = [r[0] for r in df.select(paste_names("f", "l", na_text=None)).collect()]
    assert got == ["Ann Lee", "Lee", None]


def test_at_least_year_equals_year_filter_and_is_pushed(spark, scratch):
    ts = [dt.datetime(2025, 12, 31, 23, 59, 59), dt.datetime(2026, 1, 1), dt.datetime(2027, 5, 1), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id int, d timestamp_ntz")
    df.write.parquet(f"{scratch}/t")
    back = spark.read.parquet(f"{scratch}/t")
    ranged = back.where(at_least_year(back, "d", 2026))
    wrapped = back.where(F.year("d") >= 2026)
    assert sorted(r.id for r in ranged.collect()) == sorted(r.id for r in wrapped.collect()) == [1, 2]
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d," in plan


def test_at_least_year_on_date_column(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 31),), (dt.date(2026, 1, 1),)], "d date")
    assert df.where(at_least_year(df, "d", 2026)).count() == 1


def test_stable_member_id_is_deterministic_and_uuid_shaped(spark):
    df = spark.createDataFrame([(1, "a@b.test"), (1, "a@b.test"), (2, None)], "x long, e string")
    ids = [r[0] for r in df.select(stable_member_id("x", "e")).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]
