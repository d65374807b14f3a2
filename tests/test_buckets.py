"""Targets kept in buckets: only changed buckets are written."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import functions as F

from idbridge.operators import publish_layouts, read_layouts, rewrite_changed, store_in_buckets
from idbridge.plans.pipelines import AssociationRepair, UserMapping
from idbridge.sources import FixtureTables
from tests.conftest import SF_SMALL, rows


def _digests(layout) -> dict:
    """Bucket -> names and digests of its files."""
    return {b: sorted((f, hashlib.sha256(open(f"{p}/{f}", "rb").read()).hexdigest(), os.stat(f"{p}/{f}").st_mtime_ns)
                      for f in os.listdir(p)) for b, p in layout.paths.items()}


def test_only_changed_buckets_are_written(spark, scratch):
    fx = FixtureTables(SF_SMALL)
    users = fx.target(spark, "users", ["id"]).withColumns({"bucket": F.lit("mine"), "Bucket_": F.lit(None).cast("string")})
    users = users.withColumn("tags", F.create_map(F.lit("k"), F.col("id")))
    members = fx.table(spark, "members", ["id", "email"])
    # only users 1 to 12 can change
    members = members.where(F.substring("id", -9, 9).cast("int") < 12)
    layout = store_in_buckets(users, scratch, "users", "id", 32, "v1")
    assert rows(layout.read(spark).select("id", "email")) == rows(users.select("id", "email"))
    before = _digests(layout)
    plan = UserMapping(users, members).update()
    new = UserMapping.rewrite(layout, members, scratch, "v2")
    moved = {r[0] for r in plan.changes.select(layout.bucket()).collect()}
    assert 0 < len(moved) < 16
    assert {b for b in new.paths if new.paths[b] != layout.paths[b]} == moved
    after = _digests(new)
    assert {b: x for b, x in after.items() if b not in moved} == {b: x for b, x in before.items() if b not in moved}
    assert _digests(layout) == before  # the version before stays readable
    assert new.read(spark).schema.simpleString() == users.schema.simpleString()
    assert rows(new.read(spark).drop("tags")) == rows(plan.table.drop("tags"))
    assert rows(read_layouts(spark, scratch, "v2")["users"].read(spark).drop("tags")) == rows(plan.table.drop("tags"))


def test_repeated_and_null_keys_keep_their_rows(spark, scratch):
    users = spark.createDataFrame([(1, "a@x", "M9"), (1, "b@x", "M9"), (None, "a@x", "M7"), (None, None, "M6"), (3, "z", "M5")],
                                  "id long, email string, hn_member_id string")
    members = spark.createDataFrame([("M1", "a@x"), ("M2", "b@x"), ("M3", None)], "id string, email string")
    layout = store_in_buckets(users, scratch, "users", "id", 4, "v1")
    new = UserMapping.rewrite(layout, members, scratch, "v2")
    assert rows(new.read(spark)) == rows(UserMapping(users, members).update().table)


def test_three_tables_under_one_manifest(spark, scratch):
    fx = FixtureTables(SF_SMALL)
    names = ("transactions", "reservations", "invoices")
    layouts = {n: store_in_buckets(fx.target(spark, n, ["id"]), scratch, n, "id", 8, "v1") for n in names}
    members = fx.table(spark, "members", ["id", "email"])
    job = AssociationRepair.from_tables(spark, fx)
    for cascade in (False, True):
        AssociationRepair.rewrite(layouts, members, scratch, f"c{cascade}", cascade=cascade)
        new = read_layouts(spark, scratch, f"c{cascade}")
        assert rows(new["transactions"].read(spark)) == rows(job.update_transactions().table)
        assert rows(new["reservations"].read(spark)) == rows(job.update_reservations().table)
        assert rows(new["invoices"].read(spark)) == rows(job.update_invoices(cascade).table)


def test_an_update_without_changes_writes_nothing(spark, scratch):
    users = spark.createDataFrame([(1, "a@x", "M1")], "id long, email string, hn_member_id string")
    members = spark.createDataFrame([("M1", "a@x")], "id string, email string")
    layout = store_in_buckets(users, scratch, "users", "id", 4, "v1")
    assert rewrite_changed(spark, layout, lambda t: UserMapping(t, members).update(), scratch, "v2") == layout
    assert os.listdir(f"{scratch}/users") == ["run=v1"]


def test_empty_table(spark, scratch):
    layout = store_in_buckets(spark.createDataFrame([], "id long, v string"), scratch, "t", "id", 4, "v1")
    publish_layouts(spark, [layout], scratch, "v1")
    back = read_layouts(spark, scratch, "v1")["t"]
    assert back == layout and back.read(spark).count() == 0 and back.read(spark).columns == ["id", "v"]


def test_reads_what_the_update_needs_only(spark, scratch):
    """Deciding which buckets change reads the key, the matched and the set column."""
    fx = FixtureTables(SF_SMALL)
    layout = store_in_buckets(fx.target(spark, "users", ["id"]), scratch, "users", "id", 8, "v1")
    plan = UserMapping(layout.read(spark), fx.table(spark, "members", ["id", "email"])).update()
    text = plan.changes.select(layout.bucket().alias("b")).distinct()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,email:string,hn_member_id:string>" in text
