"""Row numbers of a sorted result, without a window over all of it.

The rows are range-partitioned and sorted as for a global sort and written
once (a reliable checkpoint), which fixes the partitions and their order. A
row's number is its place in its partition plus the rows of the partitions
before; only the partitions' row counts are gathered, one number each.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from idbridge.functions.keys import quoted
from idbridge.operators.sinks import materialize

_PART, _NTH, _BEFORE = "_part", "_nth", "_before"
_IN_PARTITION = (1 << 33) - 1  # the low bits of monotonically_increasing_id count the rows of a partition


def with_ordinals(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with ``name``: 1 for the first row in ``order``, and so on. Rows that
    ``order`` does not tell apart are numbered in any order, once and for all."""
    if name in df.columns:
        raise ValueError(f"column {name!r} is there already")
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order))
    rows = rows.select(*[F.col(quoted(c)).alias(n) for c, n in names.items()], F.spark_partition_id().alias(_PART),
                       F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias(_NTH))
    sizes = sorted(tuple(r) for r in rows.groupBy(_PART).count().collect())  # one row per partition
    before = accumulate((n for _, n in sizes), initial=0)
    starts = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)],
                                             f"{_PART} int, {_BEFORE} long")
    return (rows.join(F.broadcast(starts), _PART)
            .select(*[F.col(n).alias(c) for c, n in names.items()], (F.col(_BEFORE) + F.col(_NTH) + 1).alias(name)))
