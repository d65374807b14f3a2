"""The six reconciled tables, derived from the TPC-H-style test tables.

Each view is a projection of ``customer`` or ``orders`` (``users`` also takes
the first order date per customer), so it scales with the test data and
keeps parquet column pruning: only the listed source columns are read.
The rules (which keys lose their member, get a NULL or a duplicate email,
which whitespace variant an email carries) are fixed by the fixture
definitions and exercise every matching case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TPCH_TABLES = ("customer", "orders")


def _tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _member_id(k: Column) -> Column:
    # 'M' followed by the key left-padded with zeros to 9 digits
    return F.concat(F.lit("M"), F.lpad(k.cast("string"), 9, "0"))


def _mail(k: Column) -> Column:
    return F.concat(F.lit("user"), k.cast("string"), F.lit("@mail.test"))


def _dirty(selector: Column, e: Column) -> Column:
    """One of four spellings of ``e``, chosen by ``selector % 4``:
    upper case with a trailing space, leading tab, clean, padded with spaces and CRLF."""
    m = selector % 4
    return (F.when(m == 0, F.concat(F.upper(e), F.lit(" ")))
            .when(m == 1, F.concat(F.lit("\t"), e))
            .when(m == 2, e)
            .otherwise(F.concat(F.lit("  "), e, F.lit("\r\n"))))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    e = _mail(F.when(k % 50 == 2, k - 1).otherwise(k))
    return (_tbl(spark, sf_dir, "customer").where(k % 10 != 0)
            .select(_member_id(k).alias("id"),
                    F.when(k % 700 == 7, F.lit(None).cast("string")).otherwise(_dirty(k, e)).alias("email")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = (_tbl(spark, sf_dir, "orders").groupBy("o_custkey")
             .agg(F.min("o_orderdate").alias("created_at")))
    k = F.col("c_custkey")
    e = _mail(F.when(k % 60 == 33, k - 3).otherwise(k))
    cust = _tbl(spark, sf_dir, "customer").where(k % 41 != 0).select("c_custkey")
    b = cust.join(first, cust.c_custkey == first.o_custkey, "left")
    return b.select(
        k.alias("id"),
        F.when(k % 233 == 5, F.lit(None).cast("string")).otherwise(_dirty(k + 1, e)).alias("email"),
        F.when(k % 29 == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("First"), k.cast("string"))).alias("fname"),
        F.when(k % 60 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Last"), k.cast("string"))).alias("lname"),
        F.col("created_at"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .when(k % 3 == 1, _member_id(k)).otherwise(_member_id(k + 1)).alias("hn_member_id"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return _tbl(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.when(k % 31 == 0, F.lit(None).cast("string")).otherwise(_dirty(k, _mail(c))).alias("customer_email"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 2, _member_id(c + 1)).otherwise(_member_id(c)).alias("member_id"),
        F.col("o_orderdate").alias("date"),
    )


def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return _tbl(spark, sf_dir, "orders").where(k % 3 == 0).select(
        k.alias("id"),
        F.when(k % 31 == 0, F.lit(None).cast("string")).otherwise(_dirty(k, _mail(c))).alias("customer_email"),
        F.when((k + 1) % 5 == 0, F.lit(None).cast("string"))
         .when((k + 1) % 5 == 2, _member_id(c + 1)).otherwise(_member_id(c)).alias("member_id"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return _tbl(spark, sf_dir, "orders").select(
        (k + 1000000).alias("id"),
        F.when(k % 37 == 0, F.lit(None).cast("bigint"))
         .when(k % 11 == 0, -k).otherwise(k - k % 3).alias("reservation_id"),
        _member_id(c + 2).alias("customer_id"),
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _tbl(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", k).alias("boe_event_id"),
        F.when(k % 4 == 1, k).alias("boe_ticket_id"),
    )


VIEWS = {
    "members": members,
    "users": users,
    "transactions": transactions,
    "reservations": reservations,
    "invoices": invoices,
    "tickets": tickets,
}
