"""Members sanitised once, in a table bucketed by their clean email.

All four jobs match something to members by clean email. With the index the
members are cleaned and shuffled once, when it is built; a job then shuffles only
its own side, into the index's buckets, and reads the members where they lie.

The keys that are hot in practice, NULL and the empty text, would fill one
bucket. Their members lie in a second table, and rows with such a key are
matched apart, split as in ``skew_join`` (updates: against at most two rows, which
are broadcast). A join with a bucketed side cannot be split by adaptive execution, so
other hot keys, known from sketches, are matched apart in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from idbridge.functions.keys import KEY_COLS, KEY_NULL, KEY_VAL, add_key
from idbridge.functions.text import sanitize_email
from idbridge.operators.apply import _V, two_smallest_of_keyed
from idbridge.operators.skew import SkewPolicy, product_join, skew_join

_HOT = "_hot"
_COLS = ["member_id", "email", *KEY_COLS]


def _placeholder() -> Column:
    return F.col(KEY_NULL) | (F.col(KEY_VAL) == "")


@dataclass
class MemberIndex:
    """``cold``: members by bucket of the key; ``rest``: members without an email."""

    cold: DataFrame
    rest: DataFrame

    @classmethod
    def build(cls, members: DataFrame, name: str, buckets: int, path: str | None = None) -> "MemberIndex":
        """Write the tables ``name`` and ``name_rest`` from members (id, email). ``path``:
        folder of the tables, the catalog's own if not given. Use as many buckets
        as a join of this size has shuffle partitions, or more."""
        clean = members.select(F.col("id").alias("member_id"), sanitize_email("email").alias("email"))
        keyed = add_key(clean, "email").select(*_COLS)
        parts = {name: (keyed.where(~_placeholder()).repartition(buckets, KEY_VAL).write
                        .bucketBy(buckets, KEY_VAL).sortBy(KEY_VAL)),
                 f"{name}_rest": keyed.where(_placeholder()).write}
        for table, w in parts.items():
            w = w.format("parquet").mode("overwrite")
            (w.option("path", f"{path.rstrip('/')}/{table}") if path else w).saveAsTable(table)
        return cls.open(members.sparkSession, name)

    @classmethod
    def open(cls, spark: SparkSession, name: str) -> "MemberIndex":
        return cls(spark.table(name).select(*_COLS), spark.table(f"{name}_rest").select(*_COLS))

    @property
    def clean_members(self) -> DataFrame:
        """All members: ``member_id, email`` with the email sanitised."""
        return self.cold.unionByName(self.rest).select("member_id", "email")

    def match(self, left: DataFrame, left_on: str, how: str, *, name: str = "member_id", null_safe: bool = True,
              policy: SkewPolicy | None = None, hot: DataFrame | None = None) -> DataFrame:
        """``left`` matched to members on ``left_on``: its columns, then the member id
        as ``name`` (none for anti and semi joins). NULL matches NULL where ``null_safe``.
        ``hot`` names further hot keys and their parts (``hot_from_sketches``)."""
        lookup_only = how in ("left_anti", "left_semi")
        value = [] if lookup_only else [F.col("member_id").alias(name)]
        keyed, cold, rest, apart = add_key(left, left_on), self.cold, self.rest, _placeholder()
        if hot is not None:
            known = F.broadcast(hot.select(*KEY_COLS).distinct().withColumn(_HOT, F.lit(True)))  # as small as ``hot``
            keyed, cold = (t.join(known, KEY_COLS, "left") for t in (keyed, cold))
            apart = apart | F.coalesce(F.col(_HOT), F.lit(False))
            rest = rest.unionByName(cold.where(apart).drop(_HOT))
            cold = cold.where(~apart)
        rest = rest if null_safe else rest.where(~F.col(KEY_NULL))
        cold = keyed.where(~apart).join(cold.select(KEY_VAL, *value), KEY_VAL, how)
        join = skew_join if lookup_only else product_join
        hot = join(keyed.where(apart), rest.select(*KEY_COLS, *value), KEY_COLS, how, policy=policy, hot=hot)
        cols = [*left.columns, *([] if lookup_only else [name])]
        return cold.select(*cols).unionByName(hot.select(*cols))

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Per key the two smallest member ids: of the buckets (no shuffle), and of
        the placeholder keys (two rows at most)."""
        value = F.col("member_id").alias(_V)
        return tuple(two_smallest_of_keyed(t.select(*KEY_COLS, value)) for t in (self.cold, self.rest))

    def update_args(self) -> dict:
        """Arguments of ``update_from_lookup`` that match the target through the index."""
        cold, rest = self.candidates()
        return {"candidates": cold, "join": lambda target, top2: self.join_candidates(target, top2, rest)}

    def join_candidates(self, target: DataFrame, cold: DataFrame, rest: DataFrame) -> DataFrame:
        """``target`` (with the key pair) left-joined to the candidates."""
        some = target.where(~_placeholder()).join(cold.drop(KEY_NULL), KEY_VAL, "left")
        others = target.where(_placeholder()).join(F.broadcast(rest), KEY_COLS, "left")
        return some.unionByName(others)
