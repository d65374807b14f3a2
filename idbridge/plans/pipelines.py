"""The four reconciliation jobs as lazy DataFrame plans.

Each job object takes its input tables (from any ``Tables`` source) and
exposes every intermediate the original scripts inspect as a DataFrame
property, plus a ``run`` method that writes the job's result. Nothing runs
until a property is collected or written.

- ``UserMapping``       users -> members on clean email; sets users.hn_member_id
- ``AssociationRepair`` re-points transactions, reservations and invoices at the member with their email
- ``TransactionOrphans`` report: transaction emails with no member
- ``TicketOrphans``     creates members for ticket buyers with no member
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from idbridge.functions.keys import KEY_COLS, add_key
from idbridge.functions.text import sanitize_email
from idbridge.operators.apply import (UpdatePlan, dedupe_inserts, member_inserts, smallest_two, stage,
                                      update_from_lookup)
from idbridge.operators.database import Database, StagedInsert, StagedUpdate
from idbridge.operators.checks import duplicate_joined_rows, duplicate_rows, key_counts, mapping_summary
from idbridge.operators.bloom import likely_matches
from idbridge.operators.buckets import Layout, publish_layouts, rewrite_changed
from idbridge.operators.factorised import Factorised, factorise
from idbridge.operators.index import MemberIndex
from idbridge.operators.match import match_anti, match_inner, match_left
from idbridge.operators.remap import CORRECT, coalesced, remap_id
from idbridge.operators.skew import skew_join
from idbridge.operators.sinks import materialize, publish, published, read_published, write_jdbc
from idbridge.plans.orphans import ticket_orphans, transaction_orphans
from idbridge.session import checkpoint_dir
from idbridge.sources.readers import JdbcConnection, JdbcTables, Tables

_FOUND, _OF_RESV = "_found", "_resv_member"  # of an invoice's reservation


def clean_members(members: DataFrame, index: MemberIndex | None = None) -> DataFrame:
    """``member_id, email`` with the email sanitised, from the index if there is one."""
    if index is not None:
        return index.clean_members
    return members.select(F.col("id").alias("member_id"), sanitize_email("email").alias("email"))


def apply_updates(spark: SparkSession, conn: JdbcConnection, plans: dict[str, UpdatePlan],
                  names: dict[str, str] | None = None, max_connections: int = 8) -> dict[str, int]:
    """Apply updates inside the database that ``conn`` names: each plan's changes are
    staged as ``<name>_changes``, then one UPDATE per table runs, all in one
    transaction. ``plans``: logical table name -> plan; ``names`` maps it to the
    database's name. Returns the rows changed per table."""
    db = Database(spark, conn)
    staged = []
    for name, plan in plans.items():
        rows = db.stage(plan.changes, f"{name}_changes", plan.key, max_connections=max_connections)
        staged.append(StagedUpdate((names or {}).get(name, name), rows, plan.set_col))
    return db.apply(staged)


# ---------------------------------------------------------------- P1


@dataclass
class UserMapping:
    users: DataFrame     # id, email, hn_member_id and whatever else is stored
    members: DataFrame   # id, email
    index: MemberIndex | None = None
    hot: DataFrame | None = None  # hot clean emails, from saved sketches (``hot_from_sketches``)

    @classmethod
    def from_tables(cls, spark: SparkSession, users_src: Tables, members_src: Tables,
                    index: MemberIndex | None = None) -> "UserMapping":
        return cls(users_src.target(spark, "users", ["id", "email", "hn_member_id"]),
                   members_src.table(spark, "members", ["id", "email"]), index)

    @cached_property
    def clean_members(self) -> DataFrame:
        return clean_members(self.members, self.index)

    @cached_property
    def clean_users(self) -> DataFrame:
        return self.users.select("id", sanitize_email("email").alias("email"))

    @property
    def dup_members(self) -> DataFrame:
        return duplicate_rows(self.clean_members, "email")

    @property
    def dup_users(self) -> DataFrame:
        return duplicate_rows(self.clean_users, "email")

    @property
    def mapped(self) -> DataFrame:
        """Staging rows ``id, email, member_id``: every user once per member
        with its email (NULL matches NULL), or once with NULL member_id."""
        if self.index is not None:
            return self.index.match(self.clean_users, "email", "left", hot=self.hot)
        return match_left(self.clean_users, self.clean_members.select("email", "member_id"), "email", hot=self.hot)

    @property
    def mapped_factorised(self) -> Factorised:
        """``mapped`` without its product: users and member ids per clean email."""
        return factorise(self.clean_users, self.clean_members.select("email", "member_id"), "email")

    @property
    def dup_mapped(self) -> DataFrame:
        return duplicate_joined_rows(self.clean_users, self.clean_members.select("email", "member_id"), "email")

    def update(self, *, null_safe: bool = False, stable: bool = False) -> UpdatePlan:
        """Set ``users.hn_member_id`` to a staged member id of the same user
        where that id is set and differs from the current one.

        As written, a user with no ``hn_member_id`` is never filled (``!=``
        with NULL is not true); ``null_safe=True`` uses ``IS DISTINCT FROM``.
        Candidates come from members by clean email, which equals the staging
        rows of the user's id because ``users.id`` is the key.
        """
        return update_from_lookup(
            self.users, key="id", match_col="email", match_by=sanitize_email, set_col="hn_member_id",
            lookup=self.clean_members, lookup_col="email", value_col="member_id",
            guard="null_safe" if null_safe else "sql", stable=stable,
            **(self.index.update_args() if self.index is not None else {}))

    @property
    def summary_before(self) -> DataFrame:
        return mapping_summary(self.users)

    def summary_after(self, **kw) -> DataFrame:
        return mapping_summary(self.update(**kw).table)

    @staticmethod
    def rewrite(users: Layout, members: DataFrame, root: str, run_id: str, *, null_safe: bool = False,
                stable: bool = False, index: MemberIndex | None = None) -> Layout:
        """Update a users table kept in buckets: only buckets that hold a change are written."""
        spark = members.sparkSession
        new = rewrite_changed(
            spark, users, lambda t: UserMapping(t, members, index).update(null_safe=null_safe, stable=stable), root, run_id)
        publish_layouts(spark, [new], root, run_id)
        return new

    def run(self, out_root: str, *, null_safe: bool = False, stable: bool = False,
            run_id: str | None = None) -> dict[str, str]:
        """Write the updated users table as a new version."""
        plan = self.update(null_safe=null_safe, stable=stable)
        return publish(self.users.sparkSession, {"users": plan.table}, out_root, run_id=run_id)

    def apply(self, conn: JdbcConnection, *, names: dict[str, str] | None = None, null_safe: bool = False,
              stable: bool = False, max_connections: int = 8) -> dict[str, int]:
        """Update the users table in place, inside its database."""
        return apply_updates(self.users.sparkSession, conn, {"users": self.update(null_safe=null_safe, stable=stable)},
                             names, max_connections)


# ---------------------------------------------------------------- P2


@dataclass
class AssociationRepair:
    members: DataFrame       # id, email
    transactions: DataFrame  # id, customer_email, member_id, ...
    reservations: DataFrame  # id, customer_email, member_id, ...
    invoices: DataFrame      # id, reservation_id, customer_id, ...
    index: MemberIndex | None = None
    hot: dict[str, DataFrame] | None = None  # per staging table: its hot keys, from saved sketches

    @classmethod
    def from_tables(cls, spark: SparkSession, src: Tables, index: MemberIndex | None = None) -> "AssociationRepair":
        return cls(src.table(spark, "members", ["id", "email"]),
                   src.target(spark, "transactions", ["id", "customer_email", "member_id"]),
                   src.target(spark, "reservations", ["id", "customer_email", "member_id"]),
                   src.target(spark, "invoices", ["id", "reservation_id", "customer_id"]), index)

    @cached_property
    def clean_members(self) -> DataFrame:
        return clean_members(self.members, self.index)

    @property
    def member_email_counts(self) -> DataFrame:
        """Clean member emails held by more than one member, with their count ``n``."""
        return key_counts(self.clean_members, "email", min_count=2)

    def _trans(self) -> DataFrame:
        return self.transactions.select(F.col("id").alias("transaction_id"), "member_id",
                                        sanitize_email("customer_email").alias("customer_email"))

    def _resv(self) -> DataFrame:
        return self.reservations.select(F.col("id").alias("reservation_id"), "member_id",
                                        sanitize_email("customer_email").alias("customer_email"))

    def _inv(self) -> DataFrame:
        return self.invoices.select(F.col("id").alias("invoice_id"), "reservation_id",
                                    F.col("customer_id").alias("member_id"))

    # staging tables, with dplyr's fan-out -----------------------------
    def _hot(self, name: str) -> DataFrame | None:
        return (self.hot or {}).get(name)

    def _remap(self, rows: DataFrame, name: str) -> DataFrame:
        if self.index is not None:
            return coalesced(self.index.match(rows, "customer_email", "left", name=CORRECT, hot=self._hot(name)), "member_id")
        return remap_id(rows, self.clean_members, "customer_email", "email", "member_id", "member_id", hot=self._hot(name))

    @property
    def remap_transactions(self) -> DataFrame:
        return self._remap(self._trans(), "transactions")

    @property
    def remap_reservations(self) -> DataFrame:
        return self._remap(self._resv(), "reservations")

    def remap_factorised(self, name: str) -> Factorised:
        """The staging rows of ``transactions`` or ``reservations`` without their
        product; ``coalesced(_.pairs(), "member_id")`` gives ``remap_*``."""
        rows = {"transactions": self._trans, "reservations": self._resv}[name]()
        lookup = self.clean_members.select("email", F.col("member_id").alias(CORRECT))
        return factorise(rows, lookup, "customer_email", "email")

    def remap_invoices(self, cascade: bool = False) -> DataFrame:
        """Invoices take the member of their reservation. As written, the
        reservations *before* repair are read; ``cascade`` reads the repaired ones:
        invoices meet reservations first and members last, so that the repaired
        reservations' fan-out is nowhere shuffled, sorted or held."""
        if not cascade:
            return remap_id(self._inv(), self._resv(), "reservation_id", "reservation_id", "member_id", "member_id",
                            hot=self._hot("invoices"))
        resv = self._resv().withColumn(_FOUND, F.lit(True))
        rows = match_left(self._inv(), resv.withColumnRenamed("member_id", _OF_RESV), "reservation_id",
                          hot=self._hot("invoices"))
        # clean emails start with no space: invoices without a reservation find no member
        none = F.concat(F.lit(" "), F.coalesce(F.col("invoice_id").cast("string"), F.lit("")))
        rows = rows.select("invoice_id", "reservation_id", F.coalesce(_OF_RESV, "member_id").alias("member_id"),
                           F.when(F.col(_FOUND), F.col("customer_email")).otherwise(none).alias("customer_email"))
        return self._remap(rows, "reservations").drop("customer_email")

    # updates (full new tables) ------------------------------------------
    @property
    def member_candidates(self) -> DataFrame:
        """Per clean email, the two smallest member ids: all any update needs."""
        return smallest_two(self.clean_members, "email", "member_id")

    def _update_by_email(self, table: DataFrame, email_col: str, set_col: str,
                         candidates: DataFrame | None) -> UpdatePlan:
        how = {"candidates": candidates}
        if candidates is None and self.index is not None:
            how = self.index.update_args()
        return update_from_lookup(table, key="id", match_col=email_col, match_by=sanitize_email, set_col=set_col,
                                  lookup=self.clean_members, lookup_col="email", value_col="member_id",
                                  guard="null_safe", **how)

    def update_transactions(self, candidates: DataFrame | None = None) -> UpdatePlan:
        return self._update_by_email(self.transactions, "customer_email", "member_id", candidates)

    def update_reservations(self, candidates: DataFrame | None = None) -> UpdatePlan:
        return self._update_by_email(self.reservations, "customer_email", "member_id", candidates)

    def _repaired_reservation_candidates(self, candidates: DataFrame | None) -> DataFrame:
        """``reservation_id, member_id`` rows of the repaired reservations,
        at most two per reservation (its email's two smallest member ids, or
        its own member id when no member has the email). Enough for the
        smallest-two rule, without the fan-out of the staging table."""
        top2 = candidates if candidates is not None else self.member_candidates
        cand = skew_join(add_key(self._resv(), "customer_email"), top2, KEY_COLS, "left", unique_right=True)
        values = F.when(F.col("_cand1").isNotNull(), F.array("_cand1", "_cand2")).otherwise(F.array("member_id"))
        return cand.select("reservation_id", F.explode(values).alias("member_id"))

    def update_invoices(self, cascade: bool = False, candidates: DataFrame | None = None) -> UpdatePlan:
        if cascade:
            lookup = self._repaired_reservation_candidates(candidates)
        else:
            lookup = self.reservations.select(F.col("id").alias("reservation_id"), "member_id")
        return update_from_lookup(self.invoices, key="id", match_col="reservation_id", set_col="customer_id",
                                  lookup=lookup, lookup_col="reservation_id", value_col="member_id",
                                  guard="null_safe")

    def updates(self, cascade: bool = False) -> dict[str, UpdatePlan]:
        """The three updates; the candidate table that feeds them is computed once and checkpointed."""
        cands = materialize(self.member_candidates)
        return {"transactions": self.update_transactions(cands), "reservations": self.update_reservations(cands),
                "invoices": self.update_invoices(cascade, cands)}

    @staticmethod
    def rewrite(layouts: dict[str, Layout], members: DataFrame, root: str, run_id: str, *,
                cascade: bool = False) -> dict[str, Layout]:
        """Repair transactions, reservations and invoices kept in buckets: only
        buckets that hold a change are written, and one manifest names all three."""
        spark = members.sparkSession
        before = {name: layouts[name].read(spark) for name in ("transactions", "reservations", "invoices")}
        cands = materialize(AssociationRepair(members, **before).member_candidates)

        def plan(name: str, rows: DataFrame) -> UpdatePlan:
            job = AssociationRepair(members, **{**before, name: rows})
            return (job.update_invoices(cascade, cands) if name == "invoices" else
                    getattr(job, f"update_{name}")(cands))

        new = {name: rewrite_changed(spark, layouts[name], lambda t, name=name: plan(name, t), root, run_id)
               for name in before}
        publish_layouts(spark, list(new.values()), root, run_id)
        return new

    def apply(self, conn: JdbcConnection, *, names: dict[str, str] | None = None, cascade: bool = False,
              max_connections: int = 8) -> dict[str, int]:
        """Repair the three tables in place, inside their database, in one transaction."""
        return apply_updates(self.members.sparkSession, conn, self.updates(cascade), names, max_connections)

    def run(self, out_root: str, *, cascade: bool = False, run_id: str | None = None,
            stage_to: JdbcConnection | None = None, apply_to: JdbcConnection | None = None,
            names: dict[str, str] | None = None, max_connections: int = 8) -> dict[str, str]:
        """Write the three repaired tables and their change lists, then one
        manifest naming all six.

        The member candidate table feeds all three updates, and each update
        feeds a table and a list, so these are computed once and checkpointed;
        a lost executor then costs a re-read. The lists are staged as session
        tables ``<name>_changes`` and, with ``stage_to``, overwrite tables of
        that name in the database, from which its own UPDATE can follow. With
        ``apply_to`` the same updates are then applied inside that database (``apply``).
        """
        plans = {name: plan.materialized() for name, plan in self.updates(cascade).items()}
        staged = {f"{name}_changes": stage(plan.changes, f"{name}_changes") for name, plan in plans.items()}
        if stage_to is not None:
            for name, changes in staged.items():
                write_jdbc(changes, stage_to, name, mode="overwrite", max_connections=max_connections)
        spark = self.members.sparkSession
        paths = publish(spark, {**{name: plan.table for name, plan in plans.items()}, **staged}, out_root, run_id=run_id)
        if apply_to is not None:
            apply_updates(spark, apply_to, plans, names, max_connections)
        return paths


# ---------------------------------------------------------------- P3


@dataclass
class TransactionOrphans:
    transactions: DataFrame
    members: DataFrame
    min_year: int = 2026
    collation: str | None = None
    index: MemberIndex | None = None

    @classmethod
    def from_tables(cls, spark: SparkSession, src: Tables, min_year: int = 2026,
                    index: MemberIndex | None = None) -> "TransactionOrphans":
        return cls(src.table(spark, "transactions"), src.table(spark, "members", ["id", "email"]), min_year, index=index)

    @cached_property
    def clean_members(self) -> DataFrame:
        return clean_members(self.members, self.index)

    @property
    def dup_members(self) -> DataFrame:
        return duplicate_rows(self.clean_members, "email")

    @cached_property
    def orphans_raw(self) -> DataFrame:
        return transaction_orphans(self.transactions, self.members, self.min_year, self.collation)

    def materialized(self) -> "TransactionOrphans":
        """The same job with the orphans, which three reports read, computed once."""
        self.orphans_raw = materialize(self.orphans_raw)
        return self

    def prefiltered(self) -> "TransactionOrphans":
        """The same job, matching only members whose clean email an orphan may
        hold: the others are dropped above their scan, before any shuffle. The
        orphans are computed once. ``dup_members`` still reports on all members."""
        self.materialized()
        self.likely_members = likely_matches(self.clean_members, F.col("email"), self.orphans, "customer_email")
        return self

    @property
    def orphans(self) -> DataFrame:
        """Orphan emails sanitised after the fetch; duplicates possible."""
        return self.orphans_raw.select(sanitize_email("customer_email").alias("customer_email"))

    @property
    def dup_orphans(self) -> DataFrame:
        return duplicate_rows(self.orphans, "customer_email")

    @cached_property
    def likely_members(self) -> DataFrame:
        """The members that matches are looked for in."""
        return self.clean_members

    @property
    def unmatched(self) -> DataFrame:
        if self.index is not None:
            return self.index.match(self.orphans, "customer_email", "left_anti")
        return match_anti(self.orphans, self.likely_members, "customer_email", "email")

    @property
    def matched(self) -> DataFrame:
        """Members whose clean email equals a clean orphan email: ``member_id, email``."""
        if self.index is not None:
            found = self.index.match(self.orphans, "customer_email", "inner")
            return found.select("member_id", F.col("customer_email").alias("email"))
        return match_inner(self.likely_members, self.orphans, "email", "customer_email", deal="right")


# ---------------------------------------------------------------- P4


@dataclass
class TicketOrphans:
    tickets: DataFrame
    users: DataFrame
    members: DataFrame
    na_text: str | None = "NA"
    dedupe: bool = False
    id_mode: str = "uuid"
    index: MemberIndex | None = None

    @classmethod
    def from_tables(cls, spark: SparkSession, tickets_src: Tables, members_src: Tables, **kw) -> "TicketOrphans":
        return cls(tickets_src.table(spark, "tickets"), tickets_src.table(spark, "users"),
                   members_src.table(spark, "members", ["id", "email"]), **kw)

    @cached_property
    def clean_members(self) -> DataFrame:
        return clean_members(self.members, self.index)

    @property
    def dup_members(self) -> DataFrame:
        return duplicate_rows(self.clean_members, "email")

    @cached_property
    def orphans_raw(self) -> DataFrame:
        return ticket_orphans(self.tickets, self.users)

    def materialized(self) -> "TicketOrphans":
        """The same job with the orphans, which three results read, computed once."""
        self.orphans_raw = materialize(self.orphans_raw)
        return self

    def prefiltered(self) -> "TicketOrphans":
        """The same job, matching only members whose clean email an orphan may
        hold (as in ``TransactionOrphans.prefiltered``)."""
        self.materialized()
        self.likely_members = likely_matches(self.clean_members, F.col("email"), self.orphans, "email")
        return self

    @cached_property
    def likely_members(self) -> DataFrame:
        """The members that matches are looked for in."""
        return self.clean_members

    @property
    def orphans(self) -> DataFrame:
        return self.orphans_raw.withColumn("email", sanitize_email("email"))

    @property
    def dup_orphans(self) -> DataFrame:
        return duplicate_rows(self.orphans, "email")

    @property
    def unmatched(self) -> DataFrame:
        if self.index is not None:
            return self.index.match(self.orphans, "email", "left_anti")
        return match_anti(self.orphans, self.likely_members, "email")

    @property
    def matched_factorised(self) -> Factorised:
        """``matched`` without its product."""
        return factorise(self.clean_members, self.orphans, "email", how="inner")

    @property
    def matched(self) -> DataFrame:
        if self.index is not None:
            found = self.index.match(self.orphans, "email", "inner")
            return found.select("member_id", "email", *[c for c in self.orphans.columns if c != "email"])
        return match_inner(self.likely_members, self.orphans, "email", deal="right")

    @property
    def inserts(self) -> DataFrame:
        rows = member_inserts(self.unmatched, na_text=self.na_text, id_mode=self.id_mode)
        return dedupe_inserts(rows) if self.dedupe else rows

    def run(self, conn: JdbcConnection | None = None, table: str = "members", *,
            out_root: str | None = None, run_id: str | None = None, max_connections: int = 8,
            members_src: JdbcTables | None = None, one_statement: bool = False) -> DataFrame:
        """Append the new members; a run that is repeated adds no row twice.

        The rows, with the random ids drawn for them, are first published under
        ``run_id`` (in ``out_root``, or the checkpoint folder). A rerun of the
        same ``run_id`` takes those rows instead of new ones, and the append
        leaves out the ids that the table already has, which a half-failed
        append may have left there; they are read as ``members_src`` says (its
        partitions, by many tasks). With ``one_statement`` the rows are staged in the
        database and one INSERT ... SELECT of one transaction adds those that
        the table does not hold: all or none, and no id is read.
        """
        spark = self.members.sparkSession
        root, run_id = out_root or f"{checkpoint_dir(spark)}/inserts", run_id or uuid.uuid4().hex
        if not published(spark, root, run_id):
            publish(spark, {"member_inserts": self.inserts}, root, run_id=run_id)
        rows = read_published(spark, root, run_id, "member_inserts")
        if conn is not None and one_statement:
            db, name = Database(spark, conn), f"member_inserts_{uuid.uuid5(uuid.NAMESPACE_OID, run_id).hex[:12]}"
            db.apply([StagedInsert(table, db.stage(rows, name, "id", max_connections=max_connections))])
            db.run([f"DROP TABLE {name}"])
        elif conn is not None:
            there = (members_src or JdbcTables(conn)).raw(spark, table).select("id")
            write_jdbc(rows.join(there, "id", "left_anti").select(*rows.columns), conn, table, mode="append",
                       max_connections=max_connections)
        return rows
