"""Join results kept without their product: both sides' rows per key, paired on read.

A staging table holds every pair of matching rows; a key with m and n rows has
m * n of them. Factorised, a key has one row with the list of its left and the
list of its right rows, in blocks of about ``block`` rows where there are
many. What is written follows the inputs. Equal rows are held once, with their number.

Reading pairs the lists: in place where a key has one block, which needs no
shuffle, else block by block, in cells dealt to all tasks, so a hot key's pairs are
made by many and only where they are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from idbridge.functions.keys import KEY_COLS, KEY_NULL, add_key, quoted
from idbridge.operators.skew import skew_join

_N, _BLOCK, _BLOCKS, _LEFT, _RIGHT = "_times", "_block", "_blocks", "_left", "_right"
_ROW, _COL, _ROWS, _COLS, _ALONE = "_row", "_col", "_rows", "_cols", "_alone"  # of a key's cells


def _blocks(rows: DataFrame, side: str, block: int) -> DataFrame:
    """Key pair, block number, the block's distinct rows with their number, and the key's blocks."""
    cols = [c for c in rows.columns if c not in KEY_COLS]
    some = rows.groupBy(*[quoted(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias(_N))
    sizes = some.groupBy(*KEY_COLS).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(_BLOCKS))
    dealt = skew_join(some, sizes, KEY_COLS, "inner", unique_right=True)
    number = F.pmod(F.xxhash64(*[quoted(c) for c in cols]), F.col(_BLOCKS)).cast("int")
    item = F.struct(*[quoted(c) for c in cols], _N)
    return (dealt.groupBy(*KEY_COLS, number.alias(_BLOCK)).agg(F.collect_list(item).alias(side),
                                                              F.max(_BLOCKS).alias(f"{_BLOCKS}{side}")))


@dataclass(frozen=True)
class Factorised:
    """``rows``: one row per key and block. ``save`` and read back at will; ``pairs`` expands."""

    rows: DataFrame
    left: list[str]
    right: list[str]
    how: str

    def with_rows(self, rows: DataFrame) -> "Factorised":
        """The same result read from where ``rows`` was saved."""
        return Factorised(rows, self.left, self.right, self.how)

    def pairs(self) -> DataFrame:
        """Every pair, as the plain join gives them."""
        many = (F.coalesce(f"{_BLOCKS}{_LEFT}", F.lit(0)) > 1) | (F.coalesce(f"{_BLOCKS}{_RIGHT}", F.lit(0)) > 1)
        lists = [*KEY_COLS, _LEFT, _RIGHT]
        return (self._paired(self.rows.where(~many).select(*lists))
                .unionByName(self._paired(self._cells(self.rows.where(many)).select(*lists))))

    def _cells(self, hot: DataFrame) -> DataFrame:
        """Every left block of a key with every right block. The lists are small to the
        shuffle but make many pairs, so the cells are dealt to a fixed number of
        tasks, not to as few as their bytes fill. At most one key in ``block`` rows is hot;
        their numbers of blocks are broadcast."""
        n, cell = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*KEY_COLS, _ROW, _COL]
        sizes = F.broadcast(hot.groupBy(*KEY_COLS).agg(F.max(f"{_BLOCKS}{_LEFT}").alias(_ROWS), F.max(f"{_BLOCKS}{_RIGHT}").alias(_COLS)))
        every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
        left = (hot.where(F.col(_LEFT).isNotNull()).select(*KEY_COLS, F.col(_BLOCK).alias(_ROW), _LEFT).join(sizes, KEY_COLS)
                .withColumn(_ALONE, F.col(_COLS).isNull()).withColumn(_COLS, F.coalesce(_COLS, F.lit(1)))
                .select(*KEY_COLS, _ROW, every(_COLS).alias(_COL), _ALONE, _LEFT))
        right = (hot.where(F.col(_RIGHT).isNotNull()).select(*KEY_COLS, F.col(_BLOCK).alias(_COL), _RIGHT).join(sizes, KEY_COLS)
                 .where(F.col(_ROWS).isNotNull()).select(*KEY_COLS, every(_ROWS).alias(_ROW), _COL, _RIGHT))
        dealt = left.repartition(n, *cell).join(right.repartition(n, *cell), cell, "left")
        return dealt.where(F.col(_RIGHT).isNotNull() | F.col(_ALONE))  # a hash may leave a block empty

    def _paired(self, rows: DataFrame) -> DataFrame:
        each = F.explode_outer if self.how == "left" else F.explode
        out = rows.select(F.explode(_LEFT).alias("l"), _RIGHT).select("l", each(_RIGHT).alias("r"))
        times, one = F.col(f"l.{_N}") * F.coalesce(F.col(f"r.{_N}"), F.lit(1)), F.lit(1).cast("long")
        each_time = F.when(times == 1, F.array(one)).otherwise(F.sequence(one, times))  # no new array for most pairs
        cols = [F.col(f"{s}.{quoted(c)}").alias(c) for s, names in (("l", self.left), ("r", self.right)) for c in names]
        return (out.select(*cols, F.explode(each_time).alias(_N))
                .select(*[quoted(c) for c in (*self.left, *self.right)]))


def factorise(left: DataFrame, right: DataFrame, left_on: str, right_on: str | None = None, how: str = "left", *,
              null_safe: bool = True, block: int = 4096) -> Factorised:
    """``match(left, right, left_on, right_on, how)`` for left and inner joins,
    without its product. Columns must be of types that Spark groups by."""
    if how not in ("left", "inner"):
        raise ValueError(f"join type {how!r} is not left or inner")
    right_on = right_on or left_on
    lk, rk = add_key(left, left_on), add_key(right, right_on).drop(right_on)
    if not null_safe:
        rk = rk.where(~F.col(KEY_NULL))
    rk = skew_join(rk, lk.select(*KEY_COLS), KEY_COLS, "left_semi")  # keys that the left side has
    if how == "inner":
        lk = skew_join(lk, rk.select(*KEY_COLS), KEY_COLS, "left_semi")
    rows = _blocks(lk, _LEFT, block).join(_blocks(rk, _RIGHT, block), [*KEY_COLS, _BLOCK], "full")
    return Factorised(rows, left.columns, [c for c in right.columns if c != right_on], how)
