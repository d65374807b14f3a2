"""Keep, of a large side, the rows whose key the small side may hold.

When two sources meet, most rows of the large one often match nothing. A Bloom
filter of the small side's keys, built by Spark and broadcast, drops them right
above the scan, before they are shuffled. It is exact for joins that need
matching rows only: a kept row may still match nothing, a dropped one cannot.

The filter is a table of 64-bit words: a key takes one word and four of its
bits. Its size follows from the number of distinct keys, which is counted
first; beyond ``max_words`` no filter is built and the rows are returned as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from idbridge.functions.keys import quoted

BITS_PER_KEY = 16
BITS_SET = 4
MAX_WORDS = 1 << 21  # 2 million rows of two longs: at most about 50 MB in an executor
_WORD, _MASK, _FILTER = "_bloom_word", "_bloom_mask", "_bloom_filter"


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), key), F.lit(words))


def _mask(key: Column) -> Column:
    """Four of 64 bits, from six bits each of one hash."""
    h = F.xxhash64(F.lit("mask"), key)
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"),
                                    F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    return reduce(lambda a, b: a.bitwiseOR(b), [bit(i) for i in range(BITS_SET)])


def likely_matches(df: DataFrame, on: Column, keys: DataFrame, key: str, *, max_words: int = MAX_WORDS) -> DataFrame:
    """``df`` without most rows whose ``on`` is not among ``keys[key]`` (read
    twice: counted, then built into the filter). NULL is a key like any other."""
    distinct = keys.select(F.col(quoted(key)).cast("string").alias("k")).distinct()
    words = max(1, -(-distinct.count() * BITS_PER_KEY // 64))
    if words > max_words:
        return df
    own = F.coalesce(F.col("k"), F.lit("\u0000"))
    table = (distinct.select(_word(own, words).alias(_WORD), _mask(own).alias(_MASK))
             .groupBy(_WORD).agg(F.bit_or(_MASK).alias(_FILTER)))
    value = F.coalesce(on.cast("string"), F.lit("\u0000"))
    cols = [F.col(quoted(c)) for c in df.columns]
    kept = (df.select(*cols, _word(value, words).alias(_WORD), _mask(value).alias(_MASK))
            .join(F.broadcast(table), _WORD)
            .where(F.col(_FILTER).bitwiseAND(F.col(_MASK)) == F.col(_MASK)))
    return kept.select(*cols)
