"""Sources and sinks: JDBC on in-memory Derby (no port), parquet versions."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from idbridge.operators.sinks import materialize, publish, read_published, write_jdbc
from idbridge.plans.pipelines import TicketOrphans, UserMapping
from idbridge.sources import (FixtureTables, JdbcConnection, JdbcTables, KeyRanges, ParquetTables, Partitioning,
                              check_schema)
from tests.conftest import SF_SMALL, rows


@pytest.fixture()
def derby():
    name = f"mem_{uuid.uuid4().hex[:8]}"
    return JdbcConnection(kind="derby", database=f"memory:{name};create=true")


def test_unknown_kind_is_rejected():
    with pytest.raises(ValueError):
        JdbcConnection(kind="oracle", database="x").options()


def test_password_comes_from_environment(monkeypatch):
    conn = JdbcConnection(kind="postgres", database="db", host="h", port=5432, user="u", password_env="IDB_PW")
    monkeypatch.delenv("IDB_PW", raising=False)
    with pytest.raises(RuntimeError):
        conn.options()
    monkeypatch.setenv("IDB_PW", "s3cret")
    opts = conn.options()
    assert opts["url"] == "jdbc:postgresql://h:5432/db" and opts["password"] == "s3cret"
    assert JdbcConnection(kind="mysql", database="d", host="h", port=3306).options()["url"] == "jdbc:mysql://h:3306/d"


def test_jdbc_round_trip_with_partitioned_read(spark, derby):
    fx = FixtureTables(SF_SMALL)
    for name in ("users", "members", "tickets"):
        write_jdbc(fx.table(spark, name), derby, name.upper(), mode="overwrite", max_connections=2)
    src = JdbcTables(derby, names={"users": "USERS", "members": "MEMBERS", "tickets": "TICKETS"},
                     partitions={"tickets": Partitioning("id", 0, 6000, 4)})
    tickets = src.table(spark, "tickets")
    assert tickets.rdd.getNumPartitions() == 4
    assert rows(tickets) == rows(fx.table(spark, "tickets"))
    # the same job over JDBC sources gives the same mapping as over parquet
    via_jdbc = UserMapping.from_tables(spark, src, src).mapped
    via_files = UserMapping.from_tables(spark, fx, fx).mapped
    mixed = UserMapping.from_tables(spark, users_src=src, members_src=fx).mapped
    assert rows(via_jdbc) == rows(via_files) == rows(mixed)


def test_jdbc_query_source_and_filter_pushdown(spark, derby):
    fx = FixtureTables(SF_SMALL)
    write_jdbc(fx.table(spark, "tickets"), derby, "TICKETS", mode="overwrite")
    src = JdbcTables(derby)
    q = src.query(spark, 'SELECT "id", "user_id" FROM TICKETS WHERE "boe_ticket_id" IS NOT NULL',
                  partition=Partitioning("id", 0, 6000, 3))
    assert q.count() == fx.table(spark, "tickets").where("boe_ticket_id IS NOT NULL").count()
    plan = src.raw(spark, "TICKETS").where("user_id = 5").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(user_id,5)" in plan


def test_ticket_job_appends_members_over_jdbc(spark, derby, scratch):
    fx = FixtureTables(SF_SMALL)
    job = TicketOrphans.from_tables(spark, fx, fx)
    empty = spark.createDataFrame([], job.inserts.schema)
    write_jdbc(empty, derby, "MEMBERS_OUT", mode="overwrite")
    written = job.run(derby, "MEMBERS_OUT", out_root=scratch, run_id="r1")
    back = JdbcTables(derby).raw(spark, "MEMBERS_OUT")
    assert back.count() == job.unmatched.count() == written.count()
    # the random ids were drawn once: database copy and parquet copy agree
    files = read_published(spark, scratch, "r1", "member_inserts")
    assert rows(back, "id") == rows(files, "id") == rows(written, "id")


def test_publish_writes_new_versions_and_manifest(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "id long, email string")
    paths = publish(spark, {"t": df}, scratch, run_id="v1")
    assert paths["t"].endswith("/t/run=v1")
    assert rows(read_published(spark, scratch, "v1", "t")) == [(1, "a")]
    with pytest.raises(Exception):
        publish(spark, {"t": df}, scratch, run_id="v1")  # versions are never overwritten


def test_parquet_tables_and_schema_check(spark, scratch):
    fx = FixtureTables(SF_SMALL)
    fx.table(spark, "members").write.parquet(f"{scratch}/crm/members")
    src = ParquetTables(scratch, names={"members": "crm/members"})
    assert src.table(spark, "members", ["id", "email"]).count() == fx.table(spark, "members").count()
    bad = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError):
        check_schema(bad, "members")
    with pytest.raises(TypeError):
        check_schema(spark.createDataFrame([(1, "a")], "id long, email string"), "members", strict_types=True)


def test_materialize_uses_session_checkpoint_dir(spark):
    df = spark.range(10).selectExpr("id", "uuid() AS u")
    m = materialize(df)
    assert rows(m) == rows(m)  # the random column is fixed once written


def test_association_repair_run_publishes_three_tables(spark, scratch):
    from idbridge.plans.pipelines import AssociationRepair
    fx = FixtureTables(SF_SMALL)
    job = AssociationRepair.from_tables(spark, fx)
    paths = job.run(scratch, cascade=True, run_id="p2")
    assert sorted(paths) == ["invoices", "invoices_changes", "reservations", "reservations_changes", "transactions",
                             "transactions_changes"]
    for name, plan in [("transactions", job.update_transactions()), ("reservations", job.update_reservations()),
                       ("invoices", job.update_invoices(cascade=True))]:
        assert rows(read_published(spark, scratch, "p2", name)) == rows(plan.table)


def test_stage_registers_a_temp_view(spark):
    from idbridge.operators import stage
    df = spark.createDataFrame([(1, "M1")], "id long, member_id string")
    staged = stage(df, "stg_test_mapping")
    assert spark.catalog.tableExists("stg_test_mapping")
    assert rows(staged) == rows(spark.sql("SELECT * FROM stg_test_mapping")) == [(1, "M1")]


def test_checkpoint_dir_comes_from_the_session(spark):
    from idbridge.session import checkpoint_dir
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_members_are_read_by_key_ranges(spark, derby):
    """A string key is read by several tasks, each row once, NULL ids included."""
    ids = [None, None, "", "M", "M000000001", "M0000009", "a'b", "zz"] + [f"M{i:09d}" for i in range(300)]
    df = spark.createDataFrame([(i, f"e{n}") for n, i in enumerate(ids)], "id string, email string")
    write_jdbc(df, derby, "MEMBERS", mode="overwrite")
    ranges = KeyRanges('CAST("id" AS VARCHAR(40))', [  # Spark creates string columns as CLOB in Derby
        "M000000100", "M000000200", "a'a"])
    src = JdbcTables(derby, names={"members": "MEMBERS"}, partitions={"members": ranges})
    got = src.table(spark, "members")
    assert got.rdd.getNumPartitions() == 4
    assert rows(got) == rows(df)
    sizes = got.groupBy(F.spark_partition_id()).count().count()
    assert sizes == 4
    assert KeyRanges.hex("id", 4).predicates() == [
        "id < '4' OR id IS NULL", "id >= '4' AND id < '8'", "id >= '8' AND id < 'c'", "id >= 'c'"]
    assert len(set(KeyRanges.hex("id", 100).cuts)) == 99


def test_updates_keep_every_stored_column_and_type(spark, scratch):
    """Extra columns and foreign types survive ``run`` for all four tables; transactions need no date."""
    from idbridge.plans.pipelines import AssociationRepair
    fx = FixtureTables(SF_SMALL)
    extra = {"amount": F.lit("12.30").cast("decimal(9,2)"), "status": F.lit("open"),
             "seen": F.lit("2024-01-02 03:04:05").cast("timestamp"), "tags": F.array(F.lit("a"), F.lit(None))}
    for name in ("users", "transactions", "reservations", "invoices"):
        df = fx.table(spark, name).withColumns(extra)
        df = df.drop("date") if name == "transactions" else df
        df = df.withColumn("created_at", F.col("created_at").cast("date")) if name == "users" else df
        df.write.parquet(f"{scratch}/in/{name}")
    fx.table(spark, "members").write.parquet(f"{scratch}/in/members")
    src = ParquetTables(f"{scratch}/in")
    UserMapping.from_tables(spark, src, src).run(f"{scratch}/out", run_id="u")
    AssociationRepair.from_tables(spark, src).run(f"{scratch}/out", run_id="r")
    for run, name, changed in [("u", "users", "hn_member_id"), ("r", "transactions", "member_id"),
                               ("r", "reservations", "member_id"), ("r", "invoices", "customer_id")]:
        before, after = src.raw(spark, name), read_published(spark, f"{scratch}/out", run, name)
        assert after.schema == before.schema
        same = [c for c in before.columns if c != changed]
        assert rows(after, *same) == rows(before, *same)
        assert rows(after, "id", changed) != rows(before, "id", changed)
        if run == "r":
            moved = read_published(spark, f"{scratch}/out", run, f"{name}_changes")
            old = {r["id"]: r[changed] for r in before.collect()}
            new = {r["id"]: r[changed] for r in after.collect()}
            assert {(r["id"], r[f"old_{changed}"], r[f"new_{changed}"]) for r in moved.collect()} == \
                {(k, old[k], new[k]) for k in old if old[k] != new[k]}


def test_change_lists_are_staged_in_the_database(spark, derby, scratch):
    from idbridge.plans.pipelines import AssociationRepair
    fx = FixtureTables(SF_SMALL)
    job = AssociationRepair.from_tables(spark, fx)
    job.run(scratch, run_id="s", stage_to=derby, max_connections=2)
    for name in ("transactions", "reservations", "invoices"):
        want = read_published(spark, scratch, "s", f"{name}_changes")
        assert rows(JdbcTables(derby).raw(spark, f"{name}_changes")) == rows(want)


def test_append_run_again_adds_no_row_twice(spark, derby, scratch):
    fx = FixtureTables(SF_SMALL)
    job = TicketOrphans.from_tables(spark, fx, fx)
    write_jdbc(spark.createDataFrame([], job.inserts.schema), derby, "MEMBERS_OUT", mode="overwrite")
    n = job.unmatched.count()
    # a first run that dies half-way: published, some rows appended
    publish(spark, {"member_inserts": job.inserts}, scratch, run_id="half")
    some = read_published(spark, scratch, "half", "member_inserts").limit(n // 2)
    write_jdbc(some, derby, "MEMBERS_OUT")
    for _ in range(2):
        job.run(derby, "MEMBERS_OUT", out_root=scratch, run_id="half")
        back = JdbcTables(derby).raw(spark, "MEMBERS_OUT")
        assert back.count() == back.select("id").distinct().count() == n
    assert rows(back, "id") == rows(read_published(spark, scratch, "half", "member_inserts"), "id")
