"""Named queries over the fixture tables: one per operator or pipeline step.

Every query reads the TPC-H-style tables in ``sf_dir`` through the fixture
views, so its work grows with the data. Queries named ``indexed_``,
``rewritten_``, ``ledger_``, ``prefiltered_``, ``factorised_`` and ``ranked_`` compute the results of others by the
operators of those names, from tables that they write first.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from idbridge.operators.apply import stage
from idbridge.operators.buckets import Layout, store_in_buckets
from idbridge.operators.checks import duplicate_rows, ranked_report, row_count
from idbridge.operators.factorised import Factorised
from idbridge.operators.index import MemberIndex
from idbridge.operators.ledger import Ledger
from idbridge.operators.remap import coalesced
from idbridge.plans.pipelines import AssociationRepair, TicketOrphans, TransactionOrphans, UserMapping, clean_members
from idbridge.session import checkpoint_dir
from idbridge.sources.readers import FixtureTables, ParquetTables

# The reference cut-off year is 2026; the test data ends in 2001, so the
# registered query uses 1998 to leave rows to report.
TEST_MIN_YEAR = 1998

Query = Callable[[SparkSession, str], DataFrame]


def p1(spark: SparkSession, sf_dir: str) -> UserMapping:
    t = FixtureTables(sf_dir)
    return UserMapping.from_tables(spark, t, t)


def p2(spark: SparkSession, sf_dir: str) -> AssociationRepair:
    return AssociationRepair.from_tables(spark, FixtureTables(sf_dir))


def p3(spark: SparkSession, sf_dir: str) -> TransactionOrphans:
    return TransactionOrphans.from_tables(spark, FixtureTables(sf_dir), TEST_MIN_YEAR)


def p4(spark: SparkSession, sf_dir: str) -> TicketOrphans:
    t = FixtureTables(sf_dir)
    return TicketOrphans.from_tables(spark, t, t)


def _new_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    # id, created_at and updated_at are drawn at run time; the rest is compared
    return p4(spark, sf_dir).inserts.select(
        "email", "name", "phone_number", "address", "email_verified", "phone_verified",
        "external_id", "member_since")


def _new_member_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the ids and times drawn at run time: as many distinct ids
    as rows, all of UUID shape, and equal creation and update times."""
    shape = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    return p4(spark, sf_dir).inserts.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        F.count_if(F.col("id").rlike(shape)).alias("n_id_shape"),
        F.count_if(F.col("created_at") == F.col("updated_at")).alias("n_same_time"),
        F.count("external_id").alias("n_external_ids"))


def _folder(spark: SparkSession, what: str) -> str:
    """A new folder for tables that a query writes, in ``spark.checkpoint.dir``; of
    this machine only where that is unset in a local session."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") and not (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="idbridge-"))
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _ranked(report: Callable[[SparkSession, str], DataFrame], key: str) -> Query:
    """A sorted report with each row's place in the order."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _folder(spark, "rank")
        return ranked_report(report(spark, sf_dir), key)
    return query


def member_index(spark: SparkSession, sf_dir: str) -> MemberIndex:
    """The members of ``sf_dir`` in buckets, built once per session."""
    name = f"idbridge_members_{hashlib.sha1(sf_dir.rstrip('/').encode()).hexdigest()[:10]}"
    if spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}_rest"):
        return MemberIndex.open(spark, name)
    members = FixtureTables(sf_dir).table(spark, "members", ["id", "email"])
    return MemberIndex.build(members, name, int(spark.conf.get("spark.sql.shuffle.partitions")), _folder(spark, "index"))


def _p1i(spark: SparkSession, sf_dir: str) -> UserMapping:
    t = FixtureTables(sf_dir)
    return UserMapping.from_tables(spark, t, t, index=member_index(spark, sf_dir))


def _p2i(spark: SparkSession, sf_dir: str) -> AssociationRepair:
    return AssociationRepair.from_tables(spark, FixtureTables(sf_dir), index=member_index(spark, sf_dir))


def _p3i(spark: SparkSession, sf_dir: str) -> TransactionOrphans:
    return TransactionOrphans.from_tables(spark, FixtureTables(sf_dir), TEST_MIN_YEAR, index=member_index(spark, sf_dir))


def _p4i(spark: SparkSession, sf_dir: str) -> TicketOrphans:
    t = FixtureTables(sf_dir)
    return TicketOrphans.from_tables(spark, t, t, index=member_index(spark, sf_dir))


def _prefiltered(job: Callable, result: str) -> Query:
    """A result of the orphan jobs with members dropped by a Bloom filter of the orphans."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _folder(spark, "orphans")
        return getattr(job(spark, sf_dir).prefiltered(), result)
    return query


def _factorised(result: Callable[[SparkSession, str], Factorised], id_col: str | None = None) -> Query:
    """A factorised result, saved, read back and expanded (and coalesced into ``id_col``)."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, f = _folder(spark, "factorised"), result(spark, sf_dir)
        f.rows.write.parquet(path)
        pairs = f.with_rows(spark.read.parquet(path)).pairs()
        return coalesced(pairs, id_col) if id_col else pairs
    return query


BUCKETS = 16  # of the targets that queries keep in buckets


def _rewritten_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users table kept in buckets, after an update that wrote only changed buckets."""
    t, root = FixtureTables(sf_dir), _folder(spark, "buckets")
    users = store_in_buckets(t.target(spark, "users", ["id"]), root, "users", "id", BUCKETS, "v1")
    return UserMapping.rewrite(users, t.table(spark, "members", ["id", "email"]), root, "v2").read(spark)


def _rewritten(name: str) -> Query:
    """One of the three repaired tables, all kept in buckets."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, root = FixtureTables(sf_dir), _folder(spark, "buckets")
        layouts: dict[str, Layout] = {
            n: store_in_buckets(t.target(spark, n, ["id"]), root, n, "id", BUCKETS, "v1")
            for n in ("transactions", "reservations", "invoices")}
        return AssociationRepair.rewrite(layouts, t.table(spark, "members", ["id", "email"]), root, "v2")[name].read(spark)
    return query


def _members_ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Ledger]:
    """Members per clean email from batches: one comes early, one deletes what
    another inserted, one is booked twice, and some are folded in between."""
    members = clean_members(FixtureTables(sf_dir).table(spark, "members", ["id", "email"]))
    part = F.pmod(F.xxhash64("member_id", "email"), F.lit(4))
    of = [members.where(part == i) for i in range(4)]
    ledger = Ledger(spark, _folder(spark, "ledger"), {"email": F.col("email")})
    ledger.commit(2, inserted=of[1], deleted=of[2])
    ledger.commit(1, inserted=of[0].unionByName(of[2]))
    ledger.compact()
    for _ in range(2):
        ledger.commit(4, inserted=of[2])
        ledger.commit(3, inserted=of[3])
    return members, ledger


def _ledger_dup_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, ledger = _members_ledger(spark, sf_dir)
    return duplicate_rows(members, "email", counts=ledger.totals())


def _ledger_mapping_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary after the update, from the batch of all users and the batch of changes."""
    job = p1(spark, sf_dir)
    total = {"total_users": F.lit(1), "matched_users": F.when(F.col("hn_member_id").isNotNull(), 1).otherwise(0)}
    ledger = Ledger(spark, _folder(spark, "ledger"), {}, total)
    changes = job.update().changes
    ledger.commit("changes", inserted=changes.select(F.col("new_hn_member_id").alias("hn_member_id")),
                  deleted=changes.select(F.col("old_hn_member_id").alias("hn_member_id")))
    ledger.commit("users", inserted=job.users)
    return ledger.totals().withColumn("missing_ids", F.col("total_users") - F.col("matched_users"))


def _staged_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change lists of the repair, staged as session tables and read by SQL."""
    job = p2(spark, sf_dir)
    names = []
    for name, plan in (("transactions", job.update_transactions()), ("reservations", job.update_reservations()),
                       ("invoices", job.update_invoices())):
        names.append(f"staged_{name}_{uuid.uuid4().hex[:8]}")
        stage(plan.changes, names[-1])
    return spark.sql(f"""
        SELECT 'transactions' AS table_name, id, old_member_id AS old_id, new_member_id AS new_id FROM {names[0]}
        UNION ALL SELECT 'reservations', id, old_member_id, new_member_id FROM {names[1]}
        UNION ALL SELECT 'invoices', id, old_customer_id, new_customer_id FROM {names[2]}""")


def _two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from one store, under a qualified name, and members from another."""
    t, root = FixtureTables(sf_dir), _folder(spark, "sources")
    t.table(spark, "users").write.parquet(f"{root}/web/site/users")
    t.table(spark, "members").write.parquet(f"{root}/crm/master/members")
    web = ParquetTables(f"{root}/web", names={"users": "site/users"})
    crm = ParquetTables(f"{root}/crm", names={"members": "master/members"})
    return UserMapping.from_tables(spark, web, crm).mapped


QUERIES: dict[str, Query] = {
    # P1: users -> members
    "mapped_users": lambda s, d: p1(s, d).mapped,
    "dup_members": lambda s, d: p1(s, d).dup_members,
    "dup_users": lambda s, d: p1(s, d).dup_users,
    "dup_mapped": lambda s, d: p1(s, d).dup_mapped,
    "update_users": lambda s, d: p1(s, d).update().table,
    "update_users_null_safe": lambda s, d: p1(s, d).update(null_safe=True).table,
    "update_users_stable": lambda s, d: p1(s, d).update(stable=True).table,
    "changed_users": lambda s, d: p1(s, d).update().changes,
    "changed_users_null_safe": lambda s, d: p1(s, d).update(null_safe=True).changes,
    "mapping_summary": lambda s, d: p1(s, d).summary_before,
    "mapping_summary_after_update": lambda s, d: p1(s, d).summary_after(),
    "user_count": lambda s, d: row_count(FixtureTables(d).table(s, "users", ["id"])),
    # P2: association repair
    "member_email_counts": lambda s, d: p2(s, d).member_email_counts,
    "remap_transactions": lambda s, d: p2(s, d).remap_transactions,
    "remap_reservations": lambda s, d: p2(s, d).remap_reservations,
    "remap_invoices": lambda s, d: p2(s, d).remap_invoices(),
    "remap_invoices_cascade": lambda s, d: p2(s, d).remap_invoices(cascade=True),
    "update_transactions": lambda s, d: p2(s, d).update_transactions().table,
    "update_reservations": lambda s, d: p2(s, d).update_reservations().table,
    "update_invoices": lambda s, d: p2(s, d).update_invoices().table,
    "update_invoices_cascade": lambda s, d: p2(s, d).update_invoices(cascade=True).table,
    "changed_transactions": lambda s, d: p2(s, d).update_transactions().changes,
    "changed_reservations": lambda s, d: p2(s, d).update_reservations().changes,
    "changed_invoices": lambda s, d: p2(s, d).update_invoices().changes,
    "changed_invoices_cascade": lambda s, d: p2(s, d).update_invoices(cascade=True).changes,
    # P3: transaction orphans
    "transaction_orphans": lambda s, d: p3(s, d).orphans_raw,
    "dup_transaction_orphans": lambda s, d: p3(s, d).dup_orphans,
    "unmatched_transaction_emails": lambda s, d: p3(s, d).unmatched,
    "matched_transaction_orphans": lambda s, d: p3(s, d).matched,
    # P4: ticket orphans -> new members
    "ticket_orphans": lambda s, d: p4(s, d).orphans_raw,
    "dup_ticket_orphans": lambda s, d: p4(s, d).dup_orphans,
    "unmatched_ticket_users": lambda s, d: p4(s, d).unmatched,
    "matched_ticket_orphans": lambda s, d: p4(s, d).matched,
    "new_members": _new_members,
    "new_member_ids": _new_member_ids,
    # sorted reports with the order in the result
    "ranked_dup_members": _ranked(lambda s, d: p1(s, d).dup_members, "email"),
    "ranked_dup_users": _ranked(lambda s, d: p1(s, d).dup_users, "email"),
    "ranked_dup_mapped": _ranked(lambda s, d: p1(s, d).dup_mapped, "email"),
    "ranked_member_email_counts": _ranked(lambda s, d: p2(s, d).member_email_counts, "email"),
    "ranked_dup_transaction_orphans": _ranked(lambda s, d: p3(s, d).dup_orphans, "customer_email"),
    "ranked_dup_ticket_orphans": _ranked(lambda s, d: p4(s, d).dup_orphans, "email"),
    # the four jobs over members kept in buckets of their clean email
    "indexed_mapped_users": lambda s, d: _p1i(s, d).mapped,
    "indexed_update_users": lambda s, d: _p1i(s, d).update().table,
    "indexed_remap_transactions": lambda s, d: _p2i(s, d).remap_transactions,
    "indexed_update_transactions": lambda s, d: _p2i(s, d).update_transactions().table,
    "indexed_unmatched_transaction_emails": lambda s, d: _p3i(s, d).unmatched,
    "indexed_matched_transaction_orphans": lambda s, d: _p3i(s, d).matched,
    "indexed_unmatched_ticket_users": lambda s, d: _p4i(s, d).unmatched,
    "indexed_matched_ticket_orphans": lambda s, d: _p4i(s, d).matched,
    # targets kept in buckets, of which an update writes only those that it changes
    "rewritten_users": _rewritten_users,
    "rewritten_transactions": _rewritten("transactions"),
    "rewritten_reservations": _rewritten("reservations"),
    "rewritten_invoices": _rewritten("invoices"),
    # checks kept up to date from batches
    "ledger_member_email_counts": lambda s, d: _members_ledger(s, d)[1].totals().where("n > 1"),
    "ledger_dup_members": _ledger_dup_members,
    "ledger_mapping_summary": _ledger_mapping_summary,
    # members that no orphan can match dropped above their scan
    "prefiltered_unmatched_transaction_emails": _prefiltered(p3, "unmatched"),
    "prefiltered_matched_transaction_orphans": _prefiltered(p3, "matched"),
    "prefiltered_unmatched_ticket_users": _prefiltered(p4, "unmatched"),
    "prefiltered_matched_ticket_orphans": _prefiltered(p4, "matched"),
    # staging written without its product, expanded on read
    "factorised_mapped_users": _factorised(lambda s, d: p1(s, d).mapped_factorised),
    "factorised_matched_ticket_orphans": _factorised(lambda s, d: p4(s, d).matched_factorised),
    "factorised_remap_transactions": _factorised(lambda s, d: p2(s, d).remap_factorised("transactions"), "member_id"),
    "factorised_remap_reservations": _factorised(lambda s, d: p2(s, d).remap_factorised("reservations"), "member_id"),
    # staging, qualified names and two sources
    "staged_changes": _staged_changes,
    "mapped_users_two_sources": _two_sources,
}
