"""Ids for inserted members."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def member_uuid() -> Column:
    """``UUID()`` per row. Non-deterministic: compute it in the last
    projection before the write, never in a plan that feeds two sinks."""
    return F.expr("uuid()")


def stable_member_id(*cols: Column | str) -> Column:
    """Deterministic UUID-shaped id from the given columns (sha-256 based).

    Reruns and task retries give the same id, so an insert can be repeated
    or checked without reading it back.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0000"))
             for c in cols]
    h = F.sha2(F.concat_ws("\u0001", *parts), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
