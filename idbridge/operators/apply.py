"""Table changes: staged UPDATE and INSERT ... SELECT as copy-on-write plans.

Parquet and JDBC tables have no row-level UPDATE in Spark, so an update is
planned as the whole new table: every target row, with the changed column
replaced where the guard allows. Writing it to a new path (``sinks``) and
switching readers over is the commit.

Winner rule. A target row can have several staged candidates (duplicate
emails fan out). The database would pick an unspecified one; here the
guard is applied first, as in the UPDATE's WHERE, then the smallest passing
candidate wins. Since candidates are distinct and at most one equals the
current value, the smallest passing candidate is the first or the second
smallest candidate of the key, so only those two are kept per key.
``row_number() <= 2`` is planned with a map-side group limit: a hot key
sends at most two rows per map task into the shuffle, and the target side
never fans out.

Any table can be a target: its columns are carried under positional names, so
no stored name or type (maps included) meets a helper column, and its rows are
dealt to join parts by the key alone. The lookup side has one row per key
whatever it holds, so an update never adds or loses a row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from idbridge.functions.ids import member_uuid, stable_member_id
from idbridge.functions.keys import KEY_COLS, KEY_NULL, key_exprs, quoted
from idbridge.functions.text import paste_names
from idbridge.operators.skew import SkewPolicy, skew_join
from idbridge.sources.schemas import MEMBER_INSERT

GUARDS = ("sql", "null_safe")
_V, _RN, _C1, _C2, _CUR, _HIT = "_v", "_rn", "_cand1", "_cand2", "_cur", "_hit"


NEW = "_new"


@dataclass
class UpdatePlan:
    """One UPDATE: ``decided`` is every target row plus the value it gets
    (``_new``, NULL when unchanged); the new table and the change list are
    both projections of it, so checkpointing ``decided`` once
    (``materialized``) serves both writes. ``names`` gives, per stored column,
    its name in ``decided``."""

    decided: DataFrame
    names: dict[str, str]
    key: str
    set_col: str

    @property
    def table(self) -> DataFrame:
        """Every target row, column updated."""
        return self.decided.select(*[
            (F.coalesce(F.col(NEW), F.col(n)) if c == self.set_col else F.col(n)).alias(c) for c, n in self.names.items()])

    @property
    def changes(self) -> DataFrame:
        """Changed rows only: key, old value, new value."""
        return self.decided.where(F.col(NEW).isNotNull()).select(
            F.col(self.names[self.key]).alias(self.key), F.col(self.names[self.set_col]).alias(f"old_{self.set_col}"),
            F.col(NEW).alias(f"new_{self.set_col}"))

    def without(self, *cols: str) -> "UpdatePlan":
        """The same update with columns left out of ``table``."""
        return UpdatePlan(self.decided, {c: n for c, n in self.names.items() if c not in cols}, self.key, self.set_col)

    def materialized(self) -> "UpdatePlan":
        """Checkpoint ``decided`` (in ``spark.checkpoint.dir``) and plan on top of it."""
        from idbridge.operators.sinks import materialize
        return UpdatePlan(materialize(self.decided.select(*self.names.values(), NEW)), self.names, self.key, self.set_col)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Staging table: a session temp view (lazy; the plan is inlined where read)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _passes(guard: str, cur: Column, v: Column) -> Column:
    if guard == "sql":
        # staged value set AND current != staged; NULL current makes '!=' NULL -> no update
        return v.isNotNull() & F.coalesce(cur != v, F.lit(False))
    # NOT (current <=> staged): a NULL current is filled
    return v.isNotNull() & ~cur.eqNullSafe(v)


def _keyed(df: DataFrame, key: str, value: str, name: str, null_safe_match: bool) -> DataFrame:
    """The key pair of ``key`` with ``value`` as ``name``."""
    pair = key_exprs(F.col(quoted(key)), df.schema[key].dataType)
    out = df.select(*[e.alias(n) for n, e in pair.items()], F.col(quoted(value)).alias(name))
    return out if null_safe_match else out.where(~F.col(KEY_NULL))


def smallest_two(lookup: DataFrame, lookup_col: str, value_col: str, *, null_safe_match: bool = True) -> DataFrame:
    """Per key of ``lookup_col``: the two smallest distinct non-null ``value_col`` values."""
    return two_smallest_of_keyed(_keyed(lookup, lookup_col, value_col, _V, null_safe_match))


def two_smallest_of_keyed(keyed: DataFrame) -> DataFrame:
    """``smallest_two`` of rows that hold the key pair and the value ``_v``."""
    lk = keyed.where(F.col(_V).isNotNull()).select(*KEY_COLS, _V).distinct()
    ranked = lk.withColumn(_RN, F.row_number().over(Window.partitionBy(*KEY_COLS).orderBy(_V)))
    return (ranked.where(F.col(_RN) <= 2)
            .groupBy(*KEY_COLS)
            .agg(F.min(_V).alias(_C1), F.max(F.when(F.col(_RN) == 2, F.col(_V))).alias(_C2)))


def update_from_lookup(target: DataFrame, *, key: str, match_col: str, set_col: str,
                       lookup: DataFrame, lookup_col: str, value_col: str,
                       match_by: Callable[[Column], Column] = lambda c: c,
                       guard: str = "null_safe", null_safe_match: bool = True, stable: bool = False,
                       candidates: DataFrame | None = None, unique_lookup: bool = False,
                       policy: SkewPolicy | None = None,
                       join: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> UpdatePlan:
    """Set ``target.set_col`` from staged candidate values where ``guard`` allows.

    Staged candidates of a target row: ``lookup.value_col`` of the lookup rows
    whose ``lookup_col`` equals ``match_by(target.match_col)`` (NULL matches NULL
    when ``null_safe_match``). ``guard`` is ``"sql"`` (value set and
    ``current != value``, three-valued) or ``"null_safe"``
    (``NOT current <=> value``). ``stable=True`` leaves a row alone when its
    current value is one of its candidates, so reruns cannot flip it.
    ``candidates`` may pass ``smallest_two(lookup, ...)`` computed (and
    checkpointed) once for several updates, and ``join`` how target rows (first)
    meet them on the key pair. ``unique_lookup`` is the caller's word that
    ``lookup_col`` never repeats: its rows are then the candidates as they are.

    The new value takes the type of the stored column; every other column of
    ``target`` stays as it is, and so does the number of rows, whatever repeats.
    """
    if guard not in GUARDS:
        raise ValueError(f"guard {guard!r} not in {GUARDS}")
    names = {c: f"c{i}" for i, c in enumerate(target.columns)}
    renamed = target.select(*[F.col(quoted(c)).alias(n) for c, n in names.items()])
    if unique_lookup:
        top2 = (_keyed(lookup, lookup_col, value_col, _C1, null_safe_match)
                .withColumn(_C2, F.lit(None).cast(lookup.schema[value_col].dataType)))
    else:
        top2 = candidates if candidates is not None else smallest_two(
            lookup, lookup_col, value_col, null_safe_match=null_safe_match)
    matched = match_by(F.col(names[match_col]))
    keyed = renamed.withColumns(key_exprs(matched, renamed.select(matched).schema[0].dataType))
    deal = [names[key]]
    joined = join(keyed, top2) if join else skew_join(keyed, top2, KEY_COLS, "left", policy=policy, unique_right=True,
                                                      deal_by=deal)
    cur, c1, c2 = F.col(names[set_col]), F.col(_C1), F.col(_C2)
    winner = F.when(_passes(guard, cur, c1), c1).when(_passes(guard, cur, c2), c2)
    if stable:
        members = _keyed(lookup, lookup_col, value_col, _CUR, null_safe_match).where(F.col(_CUR).isNotNull())
        members = members.select(*KEY_COLS, _CUR).distinct().withColumn(_HIT, F.lit(True))
        joined = skew_join(joined.withColumn(_CUR, cur), members, KEY_COLS + [_CUR], "left", policy=policy,
                           unique_right=True, deal_by=deal)
        winner = F.when(F.col(_HIT).isNull(), winner)
    decided = joined.withColumn(NEW, winner.cast(target.schema[set_col].dataType))
    return UpdatePlan(decided.select(*names.values(), NEW), names, key, set_col)


def member_inserts(unmatched: DataFrame, *, na_text: str | None = "NA", id_mode: str = "uuid") -> DataFrame:
    """Rows to append to the member table, in its column order: a new id, the
    email, ``first last`` as name, no phone or address, both verified flags
    0, creation and update time now, the user id as ``external_id`` and the
    user's creation time as ``member_since``.

    ``unmatched`` has ``user_id, email, fname, lname, created_at``. ``id_mode``
    ``"uuid"`` draws a random id per row (compute it once, right before the
    write); ``"stable"`` derives it from ``external_id`` and ``email``.
    """
    src = (unmatched.withColumnsRenamed({"user_id": "external_id", "created_at": "member_since"})
           .withColumn("name", paste_names("fname", "lname", na_text))
           .drop("fname", "lname"))
    new_id = member_uuid() if id_mode == "uuid" else stable_member_id("external_id", "email")
    now = F.current_timestamp()
    typed = {f.name: f.dataType for f in MEMBER_INSERT.fields}
    return src.select(
        new_id.alias("id"), F.col("email").cast(typed["email"]), F.col("name"),
        F.lit(None).cast(typed["phone_number"]).alias("phone_number"),
        F.lit(None).cast(typed["address"]).alias("address"),
        F.lit(0).cast(typed["email_verified"]).alias("email_verified"),
        F.lit(0).cast(typed["phone_verified"]).alias("phone_verified"),
        now.alias("created_at"),
        F.col("external_id").cast(typed["external_id"]),
        now.alias("updated_at"),
        F.col("member_since").cast(typed["member_since"]),
    )


def preview_append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The table as it reads after appending ``rows`` (columns matched by name)."""
    return table.unionByName(rows.select(*table.columns))


def dedupe_inserts(rows: DataFrame, key: str = "email") -> DataFrame:
    """Optional: one insert per key (smallest ``external_id``), for ``dedupe=True``.

    Rows without a key are not known to be one person and stay apart, one per
    ``external_id``. ``row_number() <= 1`` gets a map-side group limit, so a hot
    key ships one row per map task."""
    apart = F.when(F.col(key).isNull(), F.col("external_id"))
    w = Window.partitionBy(F.col(key), apart).orderBy(F.col("external_id").asc_nulls_last())
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 1).drop("_rn")
