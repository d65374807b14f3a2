from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from idbridge.operators import ranked_report, with_ordinals


def test_numbers_follow_the_order(spark):
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", None, "z" * 5]), rng.randrange(10**6)) for _ in range(5000)]
    df = spark.createDataFrame(data, "k string, n long").repartition(7)
    got = ranked_report(df, "k").collect()
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    assert [r[:2] for r in sorted(got, key=lambda r: r.rank)] == want
    assert sorted(r.rank for r in got) == list(range(1, 5001))


def test_no_window_over_all_rows(spark):
    df = with_ordinals(spark.range(1000).withColumn("m", F.col("id") % 7), [F.col("m"), F.col("id")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert [r.id for r in df.orderBy("rank").limit(3).collect()] == [0, 7, 14]


def test_a_key_with_most_rows_takes_many_partitions(spark):
    """A big group is cut by the other columns of the order."""
    df = spark.range(20000).withColumn("k", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # too few rows for more than one partition otherwise
    try:
        out = with_ordinals(df, [F.col("k"), F.col("id")])
    finally:
        spark.conf.set(key, "true")
    parts = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(parts) > 1
    assert out.agg(F.sum("rank")).first()[0] == 20000 * 20001 // 2


def test_empty_equal_and_clashing(spark):
    assert with_ordinals(spark.createDataFrame([], "a int"), [F.col("a")]).count() == 0
    same = with_ordinals(spark.createDataFrame([(1,)] * 9, "_nth int"), [F.col("_nth")])
    assert sorted(r["rank"] for r in same.collect()) == list(range(1, 10)) and same.columns == ["_nth", "rank"]
    with pytest.raises(ValueError):
        with_ordinals(spark.createDataFrame([(1,)], "rank int"), [F.col("rank")])
