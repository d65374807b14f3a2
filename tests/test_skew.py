from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from idbridge.functions.keys import KEY_COLS, add_key
from idbridge.operators import SkewPolicy, hot_keys, match_inner, match_left, skew, skew_join
from idbridge.operators.checks import duplicate_joined_rows, duplicate_rows
from idbridge.operators.skew import PART_L, PLAIN, SPLIT_L, SPLIT_R, _side
from tests.conftest import rows

SPLIT = SkewPolicy(hot_rows=50, rows_per_split=100)
JOINS = ["inner", "left", "left_semi", "left_anti"]


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    # force shuffle joins: a broadcast build side never needs splitting
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture()
def skewed(spark):
    # a third of the left rows on NULL, a quarter on one email, the rest spread
    left = spark.range(2400).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None))
         .when(F.col("id") % 4 == 1, F.lit("hot@x"))
         .otherwise(F.concat(F.lit("u"), (F.col("id") % 200).cast("string"), F.lit("@x"))).alias("email"))
    right = spark.createDataFrame(
        [("M1", None), ("M2", None), ("M3", "hot@x"), ("M4", "hot@x"), ("M5", "hot@x"), ("M6", "u7@x"),
         ("M7", "nobody@x")], "member_id string, email string")
    return add_key(left, "email"), add_key(right, "email").drop("email")


@pytest.fixture()
def both_hot(spark):
    # NULL is hot on both sides; "big@x" only on the build side; "lone@x" only on the probe side
    left = spark.range(900).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None))
         .when(F.col("id") % 3 == 1, F.lit("lone@x"))
         .otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string"), F.lit("@x"))).alias("email"))
    left = left.union(spark.createDataFrame([(5000, "big@x"), (5001, "big@x")], "id long, email string"))
    right = spark.range(700).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("member_id"),
        F.when(F.col("id") % 2 == 0, F.lit(None))
         .when(F.col("id") % 4 == 1, F.lit("big@x"))
         .otherwise(F.concat(F.lit("u"), (F.col("id") % 60).cast("string"), F.lit("@x"))).alias("email"))
    return add_key(left, "email"), add_key(right, "email").drop("email")


@pytest.mark.parametrize("how", JOINS)
@pytest.mark.parametrize("case", ["skewed", "both_hot"])
def test_split_join_equals_plain_join(request, case, how):
    left, right = request.getfixturevalue(case)
    plain = skew_join(left, right, KEY_COLS, how, policy=PLAIN)
    for policy in (SPLIT, SkewPolicy(), SkewPolicy(placeholder_parts=3)):
        split = skew_join(left, right, KEY_COLS, how, policy=policy)
        assert split.columns == plain.columns
        assert rows(split) == rows(plain)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_placeholders_are_dealt_to_parts_without_a_count(skewed, how):
    left, right = skewed
    one = right.groupBy(*KEY_COLS).agg(F.min("member_id").alias("member_id"))
    policy = SkewPolicy(placeholder_parts=7)
    out = skew_join(left, one, KEY_COLS, how, policy=policy, unique_right=True)
    assert rows(out) == rows(skew_join(left, one, KEY_COLS, how, policy=PLAIN, unique_right=True))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert PART_L in plan and plan.count("Range (0, 2400") == 1  # the probe side is read once
    plan = skew_join(left, right, KEY_COLS, "inner", policy=policy)._jdf.queryExecution().optimizedPlan().toString()
    assert PART_L not in plan and plan.count("Range (0, 2400") == 1


def test_empty_string_is_a_placeholder(spark):
    left = add_key(spark.range(500).select("id", F.lit("").alias("email")), "email")
    right = add_key(spark.createDataFrame([("M1", "")], "member_id string, email string"), "email").drop("email")
    out = skew_join(left, right, KEY_COLS, "left", policy=SkewPolicy(placeholder_parts=5), unique_right=True)
    assert out.where("member_id = 'M1'").count() == out.count() == 500


def test_every_hot_key_is_split_whatever_their_number(spark):
    left = add_key(spark.range(6000).select("id", (F.col("id") % 1500).cast("string").alias("email")), "email")
    policy = SkewPolicy(hot_rows=4, rows_per_split=2)
    hot = hot_keys(left, None, KEY_COLS, policy).collect()
    assert len(hot) == 1500 and {(r[SPLIT_L], r[SPLIT_R]) for r in hot} == {(2, 1)}
    right = add_key(spark.range(0, 1500, 2).select(F.col("id").cast("string").alias("email")), "email").drop("email")
    assert skew_join(left, right, KEY_COLS, "left_semi", policy=policy).count() == 3000


def test_parts_follow_the_rows(spark):
    left = add_key(spark.range(6000).select("id", F.lit("a").alias("email")), "email")
    hot = hot_keys(left, None, KEY_COLS, SkewPolicy(hot_rows=10, rows_per_split=4)).collect()
    assert [(r[SPLIT_L], r[SPLIT_R]) for r in hot] == [(1500, 1)]


def test_too_many_hot_keys_fail_loudly(skewed):
    left, right = skewed
    with pytest.raises(ValueError, match="hotRows"):
        skew_join(left, right, KEY_COLS, "inner", policy=SkewPolicy(hot_rows=1, max_broadcast_keys=3))


def test_build_side_hot_keys_get_build_parts(both_hot):
    left, right = both_hot
    hot = {(r["_k_null"], r["_k_val"]): (r[SPLIT_L], r[SPLIT_R])
           for r in hot_keys(left, right, KEY_COLS, SPLIT).collect()}
    assert hot[(True, "")] == (3, 4)  # NULL: 300 probe, 350 build rows
    assert hot[(False, "big@x")] == (1, 2)  # 2 probe, 175 build rows
    assert hot[(False, "lone@x")] == (3, 1)  # 300 probe, no build rows


@pytest.mark.parametrize("how", JOINS)
def test_equal_rows_take_different_parts(spark, how):
    """200 equal rows of one key: many parts, and the plain join's result."""
    left = add_key(spark.range(200).select(F.lit("a@x").alias("email")), "email")
    right = add_key(spark.createDataFrame([("a@x",), ("a@x",), ("b@x",)], "email string"), "email").drop("email")
    policy = SkewPolicy(hot_rows=50, rows_per_split=20)
    hot = hot_keys(left, right, KEY_COLS, policy)
    parts = _side(left, hot, KEY_COLS, SPLIT_L, PART_L, SPLIT_R, "_part_r")
    assert parts.count() == 200 and parts.select(PART_L).distinct().count() > 5
    assert rows(skew_join(left, right, KEY_COLS, how, policy=policy)) == \
        rows(skew_join(left, right, KEY_COLS, how, policy=PLAIN))


def test_part_assignment_is_deterministic(skewed):
    # a retried task must put every row in the same part
    left, _ = skewed
    hot = hot_keys(left, None, KEY_COLS, SPLIT)
    side = lambda df: rows(_side(df, hot, KEY_COLS, SPLIT_L, PART_L, SPLIT_R, "_part_r"), "id", PART_L)
    first = side(left)
    assert first == side(left.repartition(7))
    assert len({p for _, p in first}) > 1


def test_hot_key_rows_meet_each_match_once(skewed):
    left, right = skewed
    out = skew_join(left, right, KEY_COLS, "left", policy=SPLIT)
    assert PART_L in out._jdf.queryExecution().optimizedPlan().toString()
    per_id = out.groupBy("id").count()
    assert per_id.where("count > 3").count() == 0
    assert per_id.count() == left.count()


def test_operators_with_counted_splitting_match_plain(spark, skewed):
    left, _ = skewed
    users = left.drop(*KEY_COLS)
    members = spark.createDataFrame(
        [("M1", None), ("M2", None), ("M3", "hot@x"), ("M6", "u7@x")], "member_id string, email string")

    def results():
        return [rows(match_left(users, members, "email")), rows(duplicate_rows(users, "email", sort=False)),
                rows(duplicate_joined_rows(users, members, "email", sort=False))]

    plain = results()
    assert plain[2] == rows(duplicate_rows(match_left(users, members, "email"), "email", sort=False))
    spark.conf.set("idbridge.skew.hotRows", "50")
    spark.conf.set("idbridge.skew.rowsPerSplit", "100")
    try:
        assert results() == plain
    finally:
        spark.conf.unset("idbridge.skew.hotRows")
        spark.conf.unset("idbridge.skew.rowsPerSplit")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_the_product_of_placeholders_is_made_by_many_tasks(spark, how):
    left = spark.range(4000).select("id", F.lit(None).cast("string").alias("email"))
    right = spark.range(100).select(F.concat(F.lit("M"), "id").alias("member_id"), F.lit(None).cast("string").alias("email"))
    joined = (match_left if how == "left" else match_inner)(left, right, "email")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in tasks) == 400_000
    assert max(r["count"] for r in tasks) < 130_000


@pytest.mark.parametrize("block_rows", [1, 30, 2048])
@pytest.mark.parametrize("null_safe", [True, False])
def test_product_join_equals_the_plain_join(spark, both_hot, monkeypatch, block_rows, null_safe):
    """Placeholders on both sides or on one, equal rows, empty blocks, either side dealt."""
    monkeypatch.setattr(skew, "BLOCK_ROWS", block_rows)
    left, right = both_hot
    left = left.drop(*KEY_COLS).union(spark.createDataFrame([(1, ""), (1, ""), (2, None), (2, None)], "id long, email string"))
    right = right.selectExpr("member_id", "if(_k_null, null, _k_val) AS email")
    right = right.union(spark.createDataFrame([("E", ""), ("E", ""), ("N", None), ("N", None)], "member_id string, email string"))
    some = right.where("email IS NOT NULL")
    for r in (right, some, right.limit(0)):
        for join in (match_left, match_inner):
            plain = join(left, r, "email", null_safe=null_safe, policy=PLAIN)
            assert rows(join(left, r, "email", null_safe=null_safe)) == rows(plain)
        dealt = match_inner(left, r, "email", null_safe=null_safe, deal="right")
        assert dealt.columns == plain.columns and rows(dealt) == rows(plain)
    numbers = spark.createDataFrame([(1, None), (1, None), (2, 5)], "a long, k long")
    found = numbers.selectExpr("a AS b", "k")
    assert rows(match_left(numbers, found, "k")) == rows(match_left(numbers, found, "k", policy=PLAIN))
