"""What sources do themselves: the JDBC catalog, balanced ranges, Bloom filters across sources."""

from __future__ import annotations

import uuid
from statistics import mean

import pytest
from pyspark.sql import functions as F

from idbridge.operators import Database, StagedInsert, likely_matches, mapping_summary, row_count
from idbridge.operators.bloom import BITS_PER_KEY
from idbridge.plans.orphans import ticket_orphans, transaction_orphans
from idbridge.plans.pipelines import TicketOrphans, TransactionOrphans, UserMapping
from idbridge.sources import BalancedRanges, CatalogTables, FixtureTables, JdbcConnection, JdbcTables
from tests.conftest import SF_SMALL, rows

NAMES = {"tickets": "BOXOFFICE.TICKETS", "users": "USERS", "members": "CRM.MEMBERS", "transactions": "TRANSACTIONS"}


def _connection():
    return JdbcConnection(kind="derby", database=f"memory:push_{uuid.uuid4().hex[:8]};create=true")


def _load(spark, conn, df, table, key="id"):
    db = Database(spark, conn)
    kinds = {"bigint": "BIGINT", "string": "VARCHAR(80)", "timestamp_ntz": "TIMESTAMP"}
    db.run([f"CREATE TABLE {table} ({', '.join(f'{f.name} {kinds[f.dataType.simpleString()]}' for f in df.schema.fields)})"])
    upper = df.toDF(*[c.upper() for c in df.columns])  # unquoted names are upper case in Derby
    db.apply([StagedInsert(table, db.stage(upper, "LOADED", key.upper(), max_connections=2))])


@pytest.fixture(scope="module")
def web(spark):
    conn, fx = _connection(), FixtureTables(SF_SMALL)
    for name, table in NAMES.items():
        df = fx.table(spark, name)
        _load(spark, conn, df.drop("date"), table)  # a keyword in Derby
    return conn


def _scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Scan JDBC", 1)[1] for line in text.splitlines() if "Scan JDBC" in line]


def test_counts_run_inside_the_database(spark, web):
    fx, src = FixtureTables(SF_SMALL), CatalogTables(web, "APP", NAMES)
    users = src.table(spark, "users")
    summary = mapping_summary(users)
    assert rows(summary) == rows(mapping_summary(fx.table(spark, "users")))
    assert any("PushedAggregates: [COUNT(*), COUNT(HN_MEMBER_ID)]" in s for s in _scans(summary))
    count = row_count(src.table(spark, "tickets", ["id"]))  # a name with a schema
    assert rows(count) == rows(row_count(fx.table(spark, "tickets")))
    assert any("BOXOFFICE.TICKETS" in s and "PushedAggregates: [COUNT(*)]" in s for s in _scans(count))


def test_distinct_and_filters_of_the_orphans_run_inside_the_database(spark, web):
    fx, src = FixtureTables(SF_SMALL), CatalogTables(web, "APP", NAMES)
    tickets = ticket_orphans(src.table(spark, "tickets"), src.table(spark, "users"))
    assert rows(tickets) == rows(ticket_orphans(fx.table(spark, "tickets"), fx.table(spark, "users")))
    pushed = next(s for s in _scans(tickets) if "BOXOFFICE.TICKETS" in s)
    assert "PushedGroupByExpressions: [USER_ID]" in pushed
    assert "(BOE_EVENT_ID IS NOT NULL) OR (BOE_TICKET_ID IS NOT NULL)" in pushed


def test_emails_of_transactions_and_members_are_reduced_inside_the_database(spark, web):
    """DATE is a keyword in Derby: the column is added under quotes."""
    fx = FixtureTables(SF_SMALL)
    Database(spark, web).run(['CREATE TABLE APP.DATED (ID BIGINT, CUSTOMER_EMAIL VARCHAR(80), MEMBER_ID VARCHAR(80), '
                              '"DATE" TIMESTAMP)'])
    db = Database(spark, web)
    upper = fx.table(spark, "transactions")
    db.apply([StagedInsert("APP.DATED", db.stage(upper.toDF(*[c.upper() for c in upper.columns]), "LOADED2", "ID"))])
    src = CatalogTables(web, "APP", {**NAMES, "transactions": "DATED"})
    got = transaction_orphans(src.table(spark, "transactions"), src.table(spark, "members"), 1998)
    assert rows(got) == rows(transaction_orphans(fx.table(spark, "transactions"), fx.table(spark, "members"), 1998))
    trans, members = (next(s for s in _scans(got) if t in s) for t in ("APP.DATED", "CRM.MEMBERS"))
    assert "PushedGroupByExpressions: [CUSTOMER_EMAIL]" in trans and "MEMBER_ID IS NULL" in trans and "DATE >=" in trans
    assert "PushedGroupByExpressions: [EMAIL]" in members and "COUNT(*), COUNT(ID)" in members


def test_jobs_over_the_catalog_equal_those_over_files(spark, web):
    fx, src = FixtureTables(SF_SMALL), CatalogTables(web, "APP", NAMES)
    assert rows(UserMapping.from_tables(spark, src, src).update().table.select("id", "hn_member_id")) == \
        rows(UserMapping.from_tables(spark, fx, fx).update().table.select("id", "hn_member_id"))
    assert rows(TicketOrphans.from_tables(spark, src, src).unmatched) == rows(TicketOrphans.from_tables(spark, fx, fx).unmatched)


@pytest.mark.parametrize("num", [1, 2, 7, 64, 2000])
def test_balanced_ranges_of_skewed_text_keys(spark, num):
    """Most keys share a long prefix; the database finds the cuts."""
    conn = _connection()
    ids = [f"zzz-member-{i:05d}" for i in range(900)] + [f"{i:x}" for i in range(60)] + ["a'b", "", "Z", "é"]
    df = spark.createDataFrame([(i, "e") for i in ids], "id string, email string")
    _load(spark, conn, df, "MEMBERS")
    Database(spark, conn).run(["INSERT INTO MEMBERS VALUES (NULL, 'n')", "INSERT INTO MEMBERS VALUES (NULL, 'm')"])
    src = JdbcTables(conn, partitions={"MEMBERS": BalancedRanges("ID", num)})
    got = src.raw(spark, "MEMBERS")
    assert rows(got.select("ID")) == sorted([(i,) for i in [*ids, None, None]], key=repr)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.rdd.getNumPartitions() == min(num, len(ids))
    assert max(sizes) < 2 * mean(sizes) + 2  # and the two NULL keys in the first range


def test_balanced_ranges_of_numbers_and_repeated_keys(spark):
    conn = _connection()
    df = spark.createDataFrame([(i, k) for i, k in enumerate([5] * 300 + list(range(0, 5000, 10)))], "id long, ref long")
    _load(spark, conn, df, "T")
    src = JdbcTables(conn, partitions={"T": BalancedRanges("REF", 8)})
    got = src.raw(spark, "T")
    assert rows(got.select("ID")) == rows(df.select("id"))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 300 + 101  # one value is never cut
    empty = _connection()
    _load(spark, empty, df.limit(0), "T")
    assert JdbcTables(empty, partitions={"T": BalancedRanges("REF", 8)}).raw(spark, "T").count() == 0


def test_balanced_ranges_for_other_databases():
    sql = BalancedRanges("id", 4).sql("postgres", "crm.members")
    assert "ROW_NUMBER() OVER (ORDER BY id)" in sql and "crm.members" in sql


def test_bloom_filter_drops_rows_of_the_other_source(spark, web, scratch):
    """Orphans from files, members from a database: few members reach the join."""
    fx = FixtureTables(SF_SMALL)
    many = fx.table(spark, "members").select("id", "email").unionByName(
        spark.range(20000).select(F.concat(F.lit("X"), "id").alias("id"), F.concat(F.lit("other"), "id").alias("email")))
    many.write.parquet(f"{scratch}/members")
    members = spark.read.parquet(f"{scratch}/members")
    for plain, job in ((TransactionOrphans(fx.table(spark, "transactions"), members, 1998),
                        TransactionOrphans(fx.table(spark, "transactions"), members, 1998).prefiltered()),
                       (TicketOrphans(fx.table(spark, "tickets"), fx.table(spark, "users"), members),
                        TicketOrphans(fx.table(spark, "tickets"), fx.table(spark, "users"), members).prefiltered())):
        assert rows(job.unmatched) == rows(plain.unmatched)
        assert rows(job.matched) == rows(plain.matched)
        orphans = job.orphans.distinct().count()
        # what is left to shuffle: members that match, and a few of the others
        assert job.likely_members.count() < 2 * orphans + 0.03 * members.count() < 0.2 * members.count()
        assert rows(job.dup_members) == rows(plain.dup_members)


def test_bloom_filter_is_sized_by_its_keys_and_never_loses_a_match(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(
        spark.createDataFrame([(None,), ("",)], "k string"))
    big = spark.range(60000).select("id", F.concat(F.lit("k"), "id").alias("e")).unionByName(
        spark.createDataFrame([(-1, None), (-2, "")], "id long, e string"))
    kept = likely_matches(big, F.col("e"), keys, "k")
    assert kept.columns == big.columns
    assert kept.where("id < 3000").count() == 3002
    assert kept.count() < 3002 + 0.03 * 57000
    few = -(-3002 * BITS_PER_KEY // 64)
    assert likely_matches(big, F.col("e"), keys, "k", max_words=few).count() == kept.count()
    assert likely_matches(big, F.col("e"), keys, "k", max_words=few - 1) is big  # too large to broadcast
    assert likely_matches(big, F.col("e"), keys.limit(0), "k").count() == 0
