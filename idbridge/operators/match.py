"""Record matching on one key column, dplyr-style or SQL-style.

``null_safe=True`` (dplyr ``*_join``): NULL keys match each other.
``null_safe=False`` (SQL ``JOIN ... ON a = b``): NULL keys match nothing.

Output columns are dplyr's: all left columns (the left key kept under its
own name), then the right columns other than its key. Semi and anti joins
only look up keys, so the right side is first reduced to its distinct keys
with a partial aggregate: a duplicated or hot key on the right costs one
row in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from idbridge.functions.keys import KEY_COLS, KEY_NULL, add_key, quoted
from idbridge.operators.skew import PLAIN, SkewPolicy, product_join, skew_join


def _keyed_right(right: DataFrame, right_on: str, null_safe: bool) -> DataFrame:
    r = add_key(right, right_on).drop(right_on)
    if not null_safe:
        r = r.where(~r[KEY_NULL])
    return r


def match(left: DataFrame, right: DataFrame, left_on: str, right_on: str | None = None,
          how: str = "left", *, null_safe: bool = True, split_hot: bool = True,
          policy: SkewPolicy | None = None, hot: DataFrame | None = None, deal: str = "left") -> DataFrame:
    """Join ``left`` to ``right`` on ``left.left_on == right.right_on``.

    ``split_hot=False`` skips hot-key splitting, for callers whose left keys
    are already unique (after a ``distinct``). ``hot`` names the hot keys, from
    saved sketches, in place of counting. Inner and left joins split the product of
    placeholders (``product_join``) and read the ``deal`` side once, the other's
    placeholders once more; an inner join may name ``deal="right"``.
    """
    right_on = right_on or left_on
    clash = (set(left.columns) & set(right.columns)) - {right_on}
    if how in ("inner", "left") and clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; rename before matching")
    lk = add_key(left, left_on)
    rk = _keyed_right(right, right_on, null_safe)  # semi/anti: skew_join keeps distinct keys only
    if not split_hot:
        policy = PLAIN
    if how not in ("inner", "left"):
        return skew_join(lk, rk, KEY_COLS, how, policy=policy, hot=hot).drop(*KEY_COLS)
    if how == "inner" and deal == "right" and hot is None:
        cols = [*left.columns, *(c for c in rk.columns if c not in KEY_COLS)]
        return product_join(rk, lk, KEY_COLS, how, policy=policy).select(*map(quoted, cols))
    return product_join(lk, rk, KEY_COLS, how, policy=policy, hot=hot).drop(*KEY_COLS)


def match_left(left, right, left_on, right_on=None, **kw) -> DataFrame:
    return match(left, right, left_on, right_on, "left", **kw)


def match_inner(left, right, left_on, right_on=None, **kw) -> DataFrame:
    return match(left, right, left_on, right_on, "inner", **kw)


def match_anti(left, right, left_on, right_on=None, **kw) -> DataFrame:
    return match(left, right, left_on, right_on, "left_anti", **kw)


def match_semi(left, right, left_on, right_on=None, **kw) -> DataFrame:
    return match(left, right, left_on, right_on, "left_semi", **kw)
