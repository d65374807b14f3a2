"""Equi-joins that survive a hot key.

A shuffle join sends every row of one key to one task. Three means keep a
key that holds a large share of a table from running alone:

- **Adaptive execution** splits a join partition that turns out much larger
  than the others, from sizes it has measured anyway. It needs no count of
  the keys, so the inputs are read once. This is the default for joins whose
  sides may both repeat a key.
- **Placeholder parts.** In joins to a one-row-per-key side (updates, semi and
  anti joins) the keys that are hot in practice are known beforehand: NULL and
  the empty string. Their probe rows are dealt to ``placeholder_parts`` parts
  by a hash of the row (of the table's key, where the caller names it), and the at
  most two build rows are copied to each.
- **Counted splitting**, where ``idbridge.skew.hotRows`` is set. Rows per key
  are counted on each side first (one more read), and every key with at least
  that many rows on a side is split:

  1. Each such key gets ``a`` probe parts and ``b`` build parts, one for every
     ``rows_per_split`` rows. There are at most ``rows / hot_rows`` hot keys on a
     side; the table of them is counted before it is broadcast, and more than
     ``max_broadcast_keys`` is an error that says so, never a cut.
  2. Equal rows of a hot key are grouped with their number and numbered when
     expanded, so they too take different parts; row content and number
     decide the part, which a retried task gives again. A probe row of part
     ``i`` is copied to every build part ``j``, a build row of part ``j`` to
     every ``i``. Cold keys have ``a = b = 1``.
  3. The join runs on ``keys + (i, j)``: each left row meets each right row
     of its key in exactly one cell.
  4. Left joins: when ``b > 1`` the key has build rows, so a copy that finds
     none in its cell is an artefact and is dropped (build rows carry a marker).
     Semi and anti joins need the build side's distinct keys only: ``b`` is 1.

  Saved sketches of the keys (``sketch``) take the place of the count: the inputs
  are then read once here, too.

``product_join`` is for joins whose sides both repeat a placeholder, so that it gives
their product: few input bytes, which adaptive execution leaves to one task. The
build side's placeholder rows are counted (two numbers), put in blocks of
``BLOCK_ROWS``, and the probe side's are dealt to parts; every block meets every part
in a cell of its own. The probe side is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from idbridge.functions.keys import KEY_NULL, KEY_VAL, quoted

PART_L, PART_R = "_part_l", "_part_r"     # cell coordinates i, j
SPLIT_L, SPLIT_R = "_split_l", "_split_r"  # a, b per hot key
MARK = "_build_row"
COUNT = "_n"
COUNT_L, COUNT_R = "_n_l", "_n_r"
NUMBER = "_nth"

BLOCK_ROWS = 2048      # build rows of a cell: a sort-merge join holds as many at a time as objects
COPIED_ROWS = 1 << 20  # build rows that the parts of a key may add up to

JOIN_TYPES = {"inner", "left", "left_semi", "left_anti"}


@dataclass(frozen=True)
class SkewPolicy:
    """When a key is hot and how far it is split.

    Read from session settings ``idbridge.skew.*`` so a cluster run can tune
    them without code changes. ``hot_rows <= 0`` (the default) counts nothing.
    ``placeholder_parts = 1`` leaves placeholders whole; 0 stands for the
    session's number of shuffle partitions.
    """

    hot_rows: int = 0
    rows_per_split: int = 250_000
    max_broadcast_keys: int = 1_000_000
    placeholder_parts: int = 0

    @classmethod
    def from_session(cls, spark: SparkSession) -> "SkewPolicy":
        get = lambda k, d: int(spark.conf.get(f"idbridge.skew.{k}", str(d)))
        return cls(hot_rows=get("hotRows", cls.hot_rows),
                   rows_per_split=get("rowsPerSplit", cls.rows_per_split),
                   max_broadcast_keys=get("maxBroadcastKeys", cls.max_broadcast_keys),
                   placeholder_parts=get("placeholderParts", cls.placeholder_parts))

    @property
    def counted(self) -> bool:
        return self.hot_rows > 0

    def parts(self, rows_col: str) -> Column:
        """Parts for a key with ``rows_col`` rows: one per ``rows_per_split``."""
        n = F.coalesce(F.col(rows_col), F.lit(0))
        return F.greatest(F.lit(1), F.ceil(n / F.lit(self.rows_per_split))).cast("int")


PLAIN = SkewPolicy(placeholder_parts=1)


def key_counts(df: DataFrame, keys: list[str], name: str = COUNT) -> DataFrame:
    """Rows per key; the partial aggregate runs before the shuffle."""
    return df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def hot_keys(left: DataFrame, right: DataFrame | None, keys: list[str], policy: SkewPolicy) -> DataFrame:
    """Hot table ``keys, _split_l, _split_r`` for joining ``left`` to ``right``:
    every key with ``hot_rows`` rows or more on a side. A side where the key has
    fewer gets one part. ``right=None``: the build side has one row per key."""
    none = F.lit(None).cast("long")
    hot = (key_counts(left, keys, COUNT_L).where(F.col(COUNT_L) >= policy.hot_rows)
           .select(*keys, COUNT_L, none.alias(COUNT_R)))
    if right is not None:
        heavy = (key_counts(right, keys, COUNT_R).where(F.col(COUNT_R) >= policy.hot_rows)
                 .select(*keys, none.alias(COUNT_L), COUNT_R))
        hot = (hot.unionByName(heavy).groupBy(*keys)
               .agg(F.max(COUNT_L).alias(COUNT_L), F.max(COUNT_R).alias(COUNT_R)))
    return hot.select(*keys, policy.parts(COUNT_L).alias(SPLIT_L), policy.parts(COUNT_R).alias(SPLIT_R))


def _bounded(hot: DataFrame, policy: SkewPolicy) -> DataFrame | None:
    """The hot table, read once and small enough to broadcast; None if empty."""
    got = hot.limit(policy.max_broadcast_keys + 1).collect()
    if len(got) > policy.max_broadcast_keys:
        raise ValueError(f"more than {policy.max_broadcast_keys} keys have {policy.hot_rows} rows or more; "
                         "raise idbridge.skew.hotRows or idbridge.skew.maxBroadcastKeys")
    return hot.sparkSession.createDataFrame(got, hot.schema) if got else None


def _hashable(dtype: T.DataType) -> bool:
    """Whether Spark hashes and groups values of the type."""
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _dealing(df: DataFrame, deal_by: list[str] | None) -> list[str]:
    """The columns whose values decide a row's part."""
    return [quoted(c) for c in deal_by or [f.name for f in df.schema.fields if _hashable(f.dataType)]]


def _side(df: DataFrame, hot: DataFrame, keys: list[str], own: str, part: str, other: str, other_part: str,
          deal_by: list[str] | None = None) -> DataFrame:
    """``df`` with its part and a copy for every part of the other side. Equal
    rows are numbered first, unless ``deal_by`` tells rows apart or a column
    cannot be grouped."""
    cols = [quoted(c) for c in df.columns]
    marked = df.join(F.broadcast(hot), keys, "left")
    whole = marked.where(F.coalesce(F.col(own), F.lit(1)) <= 1).withColumn(part, F.lit(0))
    dealt, by = marked.where(F.col(own) > 1), _dealing(df, deal_by)
    if deal_by is None and len(by) == len(cols):
        equal = dealt.groupBy(*cols, SPLIT_L, SPLIT_R).agg(F.count(F.lit(1)).alias(COUNT))
        dealt, by = equal.withColumn(NUMBER, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COUNT)))), [*by, NUMBER]
    dealt = dealt.withColumn(part, F.pmod(F.xxhash64(*by), F.col(own)).cast("int")).drop(COUNT, NUMBER)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    return whole.unionByName(dealt).withColumn(other_part, F.explode(copies))


def _counted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: DataFrame,
                  deal_by: list[str] | None = None) -> DataFrame:
    lt = _side(left, hot, keys, SPLIT_L, PART_L, SPLIT_R, PART_R, deal_by)
    rt = _side(right, hot, keys, SPLIT_R, PART_R, SPLIT_L, PART_L).drop(SPLIT_L, SPLIT_R)
    if how == "left":
        rt = rt.withColumn(MARK, F.lit(True))
    out = lt.join(rt, keys + [PART_L, PART_R], how)
    if how == "left":
        # b > 1 means the key has build rows: a null-extended copy is an artefact
        out = out.where(F.col(MARK).isNotNull() | (F.coalesce(F.col(SPLIT_R), F.lit(1)) <= 1))
    return out


def _placeholder(df: DataFrame) -> Column:
    empty = F.col(KEY_VAL) == "" if isinstance(df.schema[KEY_VAL].dataType, T.StringType) else F.lit(False)
    return F.col(KEY_NULL) | empty


def _placeholder_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, parts: int,
                      deal_by: list[str] | None = None) -> DataFrame:
    dealt = F.pmod(F.xxhash64(*_dealing(left, deal_by)), F.lit(parts)).cast("int")
    copies = F.when(_placeholder(right), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    lt = left.withColumn(PART_L, F.when(_placeholder(left), dealt).otherwise(F.lit(0)))
    return lt.join(right.withColumn(PART_L, F.explode(copies)), [*keys, PART_L], how)


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", *,
              policy: SkewPolicy | None = None, unique_right: bool = False,
              deal_by: list[str] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join on non-null key columns ``keys`` (same names on both sides).

    Output: left columns, then right non-key columns (none for semi/anti).
    ``unique_right`` says the build side has at most one row per key (a
    per-key table). ``deal_by`` names left columns that tell left rows apart (a
    key of the table); a split key's rows are dealt by them alone, without
    hashing or grouping whole rows. ``hot`` gives the hot keys and their parts, as
    ``hot_keys`` or saved sketches (``sketch``) do, so that nothing is counted.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"join type {how!r} not in {sorted(JOIN_TYPES)}")
    out_cols = list(left.columns)
    lookup_only = how in ("left_semi", "left_anti")
    if lookup_only:
        right = right.select(*keys).distinct()
    else:
        out_cols += [c for c in right.columns if c not in keys]
    policy = policy or SkewPolicy.from_session(left.sparkSession)
    one_row = lookup_only or unique_right
    if hot is not None or policy.counted:
        if hot is None:
            hot = hot_keys(left, None if one_row else right, keys, policy)
        elif one_row:
            hot = hot.withColumn(SPLIT_R, F.lit(1))
        hot = _bounded(hot, policy)
        if hot is not None:
            return _counted_join(left, right, keys, how, hot, deal_by).select(*map(quoted, out_cols))
    parts = policy.placeholder_parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if one_row and parts > 1 and KEY_NULL in keys:
        return _placeholder_join(left, right, keys, how, parts, deal_by).select(*map(quoted, out_cols))
    return left.join(right, keys, how).select(*map(quoted, out_cols))


def product_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, *,
                 policy: SkewPolicy | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``skew_join`` for inner and left joins whose sides may both repeat a placeholder:
    its rows' product is made by many tasks, in cells of ``BLOCK_ROWS`` build rows."""
    policy = policy or SkewPolicy.from_session(left.sparkSession)
    parts = policy.placeholder_parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot is not None or policy.counted or parts <= 1:
        return skew_join(left, right, keys, how, policy=policy, hot=hot)
    out_cols = [*left.columns, *(c for c in right.columns if c not in keys)]
    # both numbers in one scalar subquery, computed once for both sides
    null, empty = F.col(KEY_NULL), _placeholder(right) & ~F.col(KEY_NULL)
    counts = right.agg(F.struct(F.count_if(null).alias("null"), F.count_if(empty).alias("empty")).alias(COUNT)).scalar()
    n = F.when(F.col(KEY_NULL), counts["null"]).otherwise(counts["empty"])
    blocks = F.greatest(F.lit(1), F.ceil(n / BLOCK_ROWS)).cast("int")
    dealt = F.greatest(F.lit(1), F.least(F.lit(8 * parts), F.floor(F.lit(COPIED_ROWS) / F.greatest(n, F.lit(1))))).cast("int")

    def part(df: DataFrame, of: Column) -> Column:  # a retried task deals as before; equal rows of other tasks go elsewhere
        number = F.pmod(F.xxhash64(*_dealing(df, None), F.spark_partition_id()), of).cast("int")
        return F.when(_placeholder(df), number).otherwise(F.lit(0))

    def copies(df: DataFrame, of: Column) -> Column:
        return F.explode(F.when(_placeholder(df) & (of > 1), F.sequence(F.lit(0), of - 1)).otherwise(F.array(F.lit(0))))

    lt = left.withColumn(PART_L, part(left, dealt)).withColumn(PART_R, copies(left, blocks))
    rt = right.withColumn(PART_R, part(right, blocks)).withColumn(PART_L, copies(right, dealt))
    if how == "left":  # a copy that meets an empty block has its rows in the others
        lt = lt.withColumn(SPLIT_R, F.when(_placeholder(left), blocks).otherwise(F.lit(1)))
        out = lt.join(rt.withColumn(MARK, F.lit(True)), [*keys, PART_L, PART_R], how)
        out = out.where(F.col(MARK).isNotNull() | (F.col(SPLIT_R) <= 1))
    else:
        out = lt.join(rt, [*keys, PART_L, PART_R], how)
    return out.select(*map(quoted, out_cols))
