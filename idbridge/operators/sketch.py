"""Heavy-hitter sketches of join keys, saved beside a table.

To split a hot key, a join must know which keys are hot; counting them reads
both inputs once more. A sketch is made when a table is written or loaded,
from one pass, and merges with the sketches of later batches; joins then take
their hot keys from it. It tracks up to ``capacity`` keys of a table of N rows: every key
with more than about 3.5 * N / capacity rows is in it, with its count to within that.

Which keys are split never changes a join's rows, so an estimate is enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from idbridge.functions.keys import KEY_COLS, KEY_NULL, KEY_VAL, add_key
from idbridge.operators.skew import COUNT_L, COUNT_R, SPLIT_L, SPLIT_R, SkewPolicy

CAPACITY = 100_000
LISTED = 10_000  # keys that one estimate lists


def key_sketch(df: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """One row with the sketch of ``df``'s keys (NULL is a key). Save it with the table."""
    pair = add_key(df.select(key), key)
    text = F.concat(F.when(F.col(KEY_NULL), "n").otherwise("v"), F.col(KEY_VAL).cast("string"))
    return pair.select(text.alias("k")).agg(F.expr(f"approx_top_k_accumulate(k, {capacity})").alias("sketch"))


def merged(sketches: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One sketch of several: of a table's batches, say."""
    return sketches.agg(F.expr(f"approx_top_k_combine(sketch, {capacity})").alias("sketch"))


def heavy_keys(sketch: DataFrame, least: int, name: str, listed: int = LISTED) -> DataFrame:
    """Key pairs with an estimated ``least`` rows or more, and that estimate as
    ``name``: the ``listed`` most frequent ones (at most the sketch's capacity)."""
    items = sketch.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {listed})")).alias("x"))
    return (items.where(F.col("x.count") >= least)
            .select((F.substring("x.item", 1, 1) == "n").alias(KEY_NULL),
                    F.expr("substring(x.item, 2)").alias(KEY_VAL), F.col("x.count").alias(name)))


def hot_from_sketches(left: DataFrame, right: DataFrame | None, policy: SkewPolicy) -> DataFrame:
    """The table of hot keys that ``skew_join`` takes, from the sketches of both
    sides; ``right`` None where the build side has one row per key. At most
    ``LISTED`` keys of a side, so it is small."""
    none = F.lit(None).cast("long")
    hot = heavy_keys(left, policy.hot_rows, COUNT_L).withColumn(COUNT_R, none)
    if right is not None:
        heavy = heavy_keys(right, policy.hot_rows, COUNT_R).withColumn(COUNT_L, none)
        hot = hot.unionByName(heavy).groupBy(*KEY_COLS).agg(F.max(COUNT_L).alias(COUNT_L), F.max(COUNT_R).alias(COUNT_R))
    return hot.select(*KEY_COLS, policy.parts(COUNT_L).alias(SPLIT_L), policy.parts(COUNT_R).alias(SPLIT_R))
