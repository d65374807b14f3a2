"""Updates and inserts inside a database: in-memory Derby in this process, no port."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from idbridge.__main__ import main
from idbridge.operators.database import Database, StagedInsert, StagedUpdate
from idbridge.operators.sinks import read_published
from idbridge.plans.pipelines import AssociationRepair, TicketOrphans, UserMapping
from idbridge.sources import MEMBER_INSERT, FixtureTables, JdbcConnection, JdbcTables, Partitioning
from tests.conftest import SF_SMALL, rows

NAMES = {"users": "web.users", "transactions": "TRANSACTIONS", "reservations": "crm.reservations", "invoices": "INVOICES",
         "members": "MEMBERS"}
TABLES = {"users": ("hn_member_id",), "transactions": ("member_id",), "reservations": ("member_id",),
          "invoices": ("customer_id",)}


def _create(spark, conn, df, table):
    """A table with short text columns and a primary key, as a real database has."""
    db = Database(spark, conn)
    kinds = {"bigint": "BIGINT", "string": "VARCHAR(80)", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
             "int": "INTEGER"}
    cols = ", ".join(f'"{f.name}" {kinds[f.dataType.simpleString()]}' + (" NOT NULL PRIMARY KEY" if f.name == "id" else "")
                     for f in df.schema.fields)
    db.run([f"CREATE TABLE {table} ({cols})"])
    db.apply([StagedInsert(table, db.stage(df, "LOADED", "id", max_connections=2))])


@pytest.fixture()
def crm(spark):
    """A database with all tables, two of them in schemas."""
    conn = JdbcConnection(kind="derby", database=f"memory:db_{uuid.uuid4().hex[:8]};create=true")
    fx = FixtureTables(SF_SMALL)
    for name in (*TABLES, "members"):
        _create(spark, conn, fx.table(spark, name), NAMES[name])
    return conn


def _stored(spark, conn, name):
    return rows(JdbcTables(conn).raw(spark, NAMES[name]), "id", *TABLES[name])


def test_users_are_updated_in_place(spark, crm):
    fx = FixtureTables(SF_SMALL)
    for how in ({}, {"null_safe": True}, {"stable": True}):
        src = JdbcTables(crm, names=NAMES)
        job = UserMapping.from_tables(spark, src, fx)
        want, n = rows(job.update(**how).table, "id", "hn_member_id"), job.update(**how).changes.count()
        assert job.apply(crm, names=NAMES, **how) == {"web.users": n}
        assert _stored(spark, crm, "users") == want


@pytest.mark.parametrize("cascade", [False, True])
def test_three_tables_equal_the_copy_on_write_tables(spark, crm, cascade):
    fx = FixtureTables(SF_SMALL)
    job = AssociationRepair.from_tables(spark, fx)  # the same rows by another way
    want = {"transactions": job.update_transactions(), "reservations": job.update_reservations(),
            "invoices": job.update_invoices(cascade)}
    done = AssociationRepair.from_tables(spark, JdbcTables(crm, names=NAMES)).apply(crm, names=NAMES, cascade=cascade)
    assert done == {NAMES[k]: p.changes.count() for k, p in want.items()} and all(done.values())
    for name, plan in want.items():
        assert _stored(spark, crm, name) == rows(plan.table, "id", *TABLES[name])


def test_a_failure_in_the_second_table_leaves_all_unchanged(spark, crm):
    before = {n: _stored(spark, crm, n) for n in TABLES}
    Database(spark, crm).run(["CREATE TRIGGER stop_it AFTER UPDATE ON crm.reservations FOR EACH ROW "
                              "VALUES 1 / (SELECT COUNT(*) FROM crm.reservations WHERE \"id\" < 0)"])
    with pytest.raises(Exception, match="divide by zero"):
        AssociationRepair.from_tables(spark, FixtureTables(SF_SMALL)).apply(crm, names=NAMES)
    assert {n: _stored(spark, crm, n) for n in TABLES} == before


def test_values_changed_meanwhile_and_repeated_runs(spark, crm):
    job = AssociationRepair.from_tables(spark, FixtureTables(SF_SMALL))
    plan = job.update_transactions()
    moved = plan.changes.orderBy("id").first()
    db = Database(spark, crm)
    db.run([f"UPDATE TRANSACTIONS SET \"member_id\" = 'other' WHERE \"id\" = {moved.id}"])
    n = plan.changes.count()
    change = StagedUpdate("TRANSACTIONS", db.stage(plan.changes, "staged_t", "id", max_connections=2), "member_id")
    assert db.apply([change]) == {"TRANSACTIONS": n - 1}
    assert dict(_stored(spark, crm, "transactions"))[moved.id] == "other"
    assert db.apply([change]) == {"TRANSACTIONS": 0}


def test_a_repeated_key_fails_before_any_change(spark, crm):
    twice = spark.createDataFrame([(1, "a", "b"), (1, "a", "c")], "id long, old_member_id string, new_member_id string")
    with pytest.raises(Exception):
        Database(spark, crm).stage(twice, "staged_twice", "id")


def _members(spark, conn, scratch):
    fx = FixtureTables(SF_SMALL)
    empty = spark.createDataFrame([], MEMBER_INSERT)
    _create(spark, conn, empty, "crm.NEW_MEMBERS")
    return TicketOrphans.from_tables(spark, fx, fx)


def test_members_are_inserted_by_one_statement(spark, crm, scratch):
    job = _members(spark, crm, scratch)
    for _ in range(2):  # the second run finds all ids there
        written = job.run(crm, "crm.NEW_MEMBERS", out_root=scratch, run_id="one", one_statement=True)
        back = JdbcTables(crm).raw(spark, "crm.NEW_MEMBERS")
        cols = ["id", "email", "name", "email_verified", "external_id", "member_since"]
        assert rows(back, *cols) == rows(written, *cols)
    assert back.count() == job.unmatched.count() > 0


def test_a_failed_insert_adds_no_row(spark, crm, scratch):
    job = _members(spark, crm, scratch)
    Database(spark, crm).run(["ALTER TABLE crm.NEW_MEMBERS ADD CONSTRAINT no_big CHECK (\"external_id\" < 40)"])
    with pytest.raises(Exception, match="NO_BIG"):
        job.run(crm, "crm.NEW_MEMBERS", out_root=scratch, run_id="bad", one_statement=True)
    assert JdbcTables(crm).raw(spark, "crm.NEW_MEMBERS").count() == 0


def test_ids_of_the_target_are_read_by_many_tasks(spark, crm):
    """Partitions are found by the database's name of the table as well."""
    src = JdbcTables(crm, names=NAMES, partitions={"transactions": Partitioning("id", 0, 6000, 4)})
    assert src.raw(spark, "TRANSACTIONS").rdd.getNumPartitions() == src.raw(spark, "transactions").rdd.getNumPartitions() == 4


def test_command_line_applies_in_the_database(spark, crm, scratch):
    with open(f"{scratch}/envs.json", "w") as f:
        json.dump({"crm": {"kind": "derby", "database": crm.database, "names": NAMES}}, f)
    args = ["--env", f"{scratch}/envs.json", "--out", f"{scratch}/out", "--apply"]
    main(["map-users", "--users", "crm", "--members", "crm", "--run-id", "u", *args], spark)
    main(["repair-associations", "--source", "crm", "--run-id", "r", *args], spark)
    for name, (col,) in TABLES.items():
        run = "u" if name == "users" else "r"
        assert _stored(spark, crm, name) == rows(read_published(spark, f"{scratch}/out", run, name), "id", col)
    moved = read_published(spark, f"{scratch}/out", "r", "invoices_changes")
    assert moved.where(F.col("new_customer_id").isNotNull()).count() > 0
