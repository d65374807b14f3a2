"""Staging rows for an id repair: left join to a lookup, keep the looked-up
id when there is one (``coalesce(correct_id, id)``).

This is the staging table the UPDATE reads. It keeps dplyr's fan-out: a
target row matching several lookup rows appears once per match, with hot
keys split across tasks by ``match``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from idbridge.operators.match import match_left

CORRECT = "correct_id"


def remap_id(target: DataFrame, lookup: DataFrame, target_key: str, lookup_key: str,
             id_col: str, lookup_id: str, *, null_safe: bool = True, **kw) -> DataFrame:
    """``target`` with ``id_col`` replaced by the matched ``lookup_id`` where one exists."""
    lk = lookup.select(F.col(lookup_key), F.col(lookup_id).alias(CORRECT))
    joined = match_left(target, lk, target_key, lookup_key, null_safe=null_safe, **kw)
    return coalesced(joined, id_col)


def coalesced(joined: DataFrame, id_col: str) -> DataFrame:
    """``id_col`` replaced by the looked-up id where there is one."""
    return joined.withColumn(id_col, F.coalesce(F.col(CORRECT), F.col(id_col))).drop(CORRECT)
