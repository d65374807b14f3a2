"""Data checks: duplicate keys and after-update counts.

``duplicate_rows`` keeps every row whose key occurs more than once, like
``group_by(k) %>% filter(n() > 1)``. A window count would send a whole key
group to one task; instead the per-key counts are a partial aggregate (a hot
key costs one row per map task), and the rows are kept by a semi join
against the duplicated keys, with placeholder keys split (``skew_join``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from idbridge.functions.keys import KEY_COLS, add_key
from idbridge.operators.match import match_left
from idbridge.operators.ordinals import with_ordinals
from idbridge.operators.skew import COUNT, SkewPolicy, key_counts as _counts, skew_join


def sorted_report(df: DataFrame, key: str, tiebreak: list[str] | None = None) -> DataFrame:
    """``arrange(key)``: ascending, NULL last, as R sorts.

    The other columns break ties, so the range partitioner can cut a large
    key group across tasks and the order is deterministic.
    """
    return df.orderBy(*report_order(df, key, tiebreak))


def report_order(df: DataFrame, key: str, tiebreak: list[str] | None = None) -> list[Column]:
    rest = tiebreak if tiebreak is not None else [c for c in df.columns if c != key]
    return [F.col(key).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in rest]


def ranked_report(df: DataFrame, key: str, tiebreak: list[str] | None = None, name: str = "rank") -> DataFrame:
    """``sorted_report`` with each row's place in it, so that the order outlives
    a write: the result itself may lie in any order."""
    return with_ordinals(df, report_order(df, key, tiebreak), name)


def duplicate_rows(df: DataFrame, key: str, *, sort: bool = True, policy: SkewPolicy | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` (NULL included, as one group) occurs more than
    once. ``counts`` (``key``, ``n``) may give the rows per key, kept elsewhere
    (``ledger``), so that they need not be counted again."""
    keyed = add_key(df, key)
    if counts is not None:
        dup_keys = add_key(counts.where("n > 1").select(key), key).select(*KEY_COLS)
    else:
        dup_keys = _counts(keyed.select(*KEY_COLS), KEY_COLS).where(F.col(COUNT) > 1).select(*KEY_COLS)
    rows = skew_join(keyed, dup_keys, KEY_COLS, "left_semi", policy=policy).drop(*KEY_COLS)
    return sorted_report(rows, key) if sort else rows


def duplicate_joined_rows(left: DataFrame, right: DataFrame, key: str, *, sort: bool = True,
                          policy: SkewPolicy | None = None) -> DataFrame:
    """``duplicate_rows(match_left(left, right, key), key)``, joined once.

    A key occurs ``n(left) * max(1, n(right))`` times in the joined rows, so
    the keys that occur more than once follow from the counts of both sides;
    only left rows of those keys are joined."""
    keyed = add_key(left, key)
    n_left = _counts(keyed, KEY_COLS, "_nl")
    n_right = _counts(add_key(right, key), KEY_COLS, "_nr")
    many = (n_left.join(n_right, KEY_COLS, "left")
            .where(F.col("_nl") * F.greatest(F.coalesce(F.col("_nr"), F.lit(1)), F.lit(1)) > 1).select(*KEY_COLS))
    some = skew_join(keyed, many, KEY_COLS, "left_semi", policy=policy).drop(*KEY_COLS)
    rows = match_left(some, right, key, policy=policy)
    return sorted_report(rows, key) if sort else rows


def key_counts(df: DataFrame, key: str, *, min_count: int = 2, name: str = "n") -> DataFrame:
    """``count(key) %>% filter(n >= min_count)``: one row per key with its row count."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
            .where(F.col(name) >= min_count))


def mapping_summary(df: DataFrame, col: str = "hn_member_id") -> DataFrame:
    """Total rows, rows with ``col`` set, rows without; all BIGINT."""
    total = F.count(F.lit(1))
    matched = F.count(F.col(col))
    return df.agg(total.cast("bigint").alias("total_users"),
                  matched.cast("bigint").alias("matched_users"),
                  (total - matched).cast("bigint").alias("missing_ids"))


def row_count(df: DataFrame, name: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
