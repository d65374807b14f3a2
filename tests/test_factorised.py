"""Staging without the product: expansion equals the join, bytes follow the inputs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from idbridge.operators import factorise, match
from tests.conftest import rows

LEFT = [(i, "hot") for i in range(40)] + [(i, None) for i in range(100, 110)] + [(200, ""), (201, "a"), (201, "a"), (202, "none")]
RIGHT = [(f"M{i}", "hot") for i in range(30)] + [("N", None), ("N", None), ("E", ""), ("A", "a"), ("B", "a"), (None, "a"), ("X", "x")]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("block", [4096, 7, 1])
def test_expansion_equals_the_join(spark, scratch, how, null_safe, block):
    left = spark.createDataFrame(LEFT, "id long, email string")
    right = spark.createDataFrame(RIGHT, "member_id string, email string")
    f = factorise(left, right, "email", how=how, null_safe=null_safe, block=block)
    f.rows.write.parquet(f"{scratch}/f")
    got = f.with_rows(spark.read.parquet(f"{scratch}/f")).pairs()
    want = match(left, right, "email", how=how, null_safe=null_safe)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_bytes_follow_the_inputs(spark, scratch):
    """Two million pairs of one key are never written."""
    left = spark.range(2000).select("id", F.lit("hot").alias("email"))
    right = spark.range(1000).select(F.concat(F.lit("M"), "id").alias("member_id"), F.lit("hot").alias("email"))
    f = factorise(left, right, "email", block=256)
    f.rows.write.parquet(f"{scratch}/f")
    left.write.parquet(f"{scratch}/l")
    right.write.parquet(f"{scratch}/r")
    size = lambda d: sum(os.path.getsize(f"{scratch}/{d}/{x}") for x in os.listdir(f"{scratch}/{d}"))
    assert size("f") < 2 * (size("l") + size("r")) + 20_000
    saved = spark.read.parquet(f"{scratch}/f")
    assert saved.agg(F.max(F.greatest(F.size("_left"), F.size("_right")))).first()[0] < 2 * 256
    assert f.with_rows(saved).pairs().count() == 2_000_000


def test_a_key_with_one_block_is_paired_in_place(spark, scratch):
    left = spark.createDataFrame(LEFT, "id long, email string")
    right = spark.createDataFrame(RIGHT, "member_id string, email string")
    f = factorise(left, right, "email")
    f.rows.write.parquet(f"{scratch}/f")
    saved = spark.read.parquet(f"{scratch}/f")
    plan = f.with_rows(saved)._paired(saved.select("_k_null", "_k_val", "_left", "_right"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_helper_names_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", "x"), (1, "a", "x")], "_block long, email string, `a.b` string")
    right = spark.createDataFrame([("a", 5)], "email string, l long")
    assert rows(factorise(left, right, "email").pairs()) == [(1, "a", "x", 5)] * 2
    assert rows(factorise(left, right.limit(0), "email").pairs()) == [(1, "a", "x", None)] * 2
    assert rows(factorise(left, right.limit(0), "email", how="inner").pairs()) == []
    assert rows(factorise(left.limit(0), right, "email").pairs()) == []
    with pytest.raises(ValueError):
        factorise(left, right, "email", how="left_anti")


def test_the_pairs_of_a_hot_key_are_made_by_many_tasks(spark, scratch):
    left = spark.range(2000).select("id", F.lit(None).cast("string").alias("email"))
    right = spark.range(500).select(F.concat(F.lit("M"), "id").alias("member_id"), F.lit(None).cast("string").alias("email"))
    f = factorise(left, right, "email", block=64)
    f.rows.write.parquet(f"{scratch}/f")
    tasks = f.with_rows(spark.read.parquet(f"{scratch}/f")).pairs().groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 1_000_000
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 300_000


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equal_rows_on_both_sides_of_a_hot_key(spark, how):
    left = spark.createDataFrame([(i % 5, "a") for i in range(40)] + [(9, "b")], "id long, email string")
    right = spark.createDataFrame([(f"M{i % 4}", "a") for i in range(30)] + [("N", "a")], "member_id string, email string")
    got = factorise(left, right, "email", how=how, block=2).pairs()
    assert rows(got) == rows(match(left, right, "email", how=how))
