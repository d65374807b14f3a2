"""Updates of tables with any columns and types, and of lookups that repeat."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from idbridge.functions import sanitize_email
from idbridge.operators import skew_join, update_from_lookup
from idbridge.operators.skew import SkewPolicy
from idbridge.plans.pipelines import AssociationRepair, UserMapping
from tests.conftest import rows

# names of helper columns, now or before, and names that the column parser would split
HELPERS = ["_new", "_clean_email", "_k_null", "_k_val", "_part_l", "_part_r", "_split_l", "_n", "_nth", "_cand1", "_cand2",
           "_cur", "_hit", "_v", "c0", "c1", "a.b", "x`y"]


def _users(spark, extra=True):
    df = spark.createDataFrame([(1, "A@x ", "M9"), (2, None, "M8"), (3, "", "M7"), (4, "b@x", None), (5, "a@x", "M1")],
                               "id long, email string, hn_member_id string")
    if extra:
        df = df.withColumns({c: F.lit(f"keep {c}") for c in HELPERS})
        df = df.withColumns({"tags": F.create_map(F.lit("k"), F.col("id")),
                             "deep": F.array(F.struct(F.create_map(F.lit("k"), F.lit(1)).alias("m")))})
    return df


def _members(spark):
    return spark.createDataFrame([("M1", "a@X"), ("M2", "b@x"), ("M3", None), ("M4", "")], "id string, email string")


CONF = [{}, {"idbridge.skew.hotRows": "1", "idbridge.skew.rowsPerSplit": "1"}, {"spark.sql.autoBroadcastJoinThreshold": "-1"}]


@pytest.mark.parametrize("conf", CONF, ids=["default", "counted", "shuffled"])
def test_update_keeps_maps_and_helper_names(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        users = _users(spark)
        plan = UserMapping(users, _members(spark)).update(null_safe=True)
        new = {r.id: r for r in plan.table.collect()}
        assert plan.table.schema == users.schema
        assert {i: r.hn_member_id for i, r in new.items()} == {1: "M1", 2: "M3", 3: "M4", 4: "M2", 5: "M1"}
        for r in users.collect():
            assert {c: new[r.id][c] for c in users.columns if c != "hn_member_id"} == \
                {c: r[c] for c in users.columns if c != "hn_member_id"}
        assert rows(plan.changes, "id") == [(1,), (2,), (3,), (4,)]
        assert rows(plan.materialized().changes) == rows(plan.changes)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("set_col", ["_new", "_cand1", "_k_val"])
def test_helper_names_may_be_set_or_matched(spark, set_col):
    target = spark.createDataFrame([(1, "a", "old"), (2, "b", None)], f"_part_l long, `a.b` string, {set_col} string")
    lookup = spark.createDataFrame([("a", "v1"), ("b", "v2")], "_v string, `c.d` string")
    plan = update_from_lookup(target, key="_part_l", match_col="a.b", set_col=set_col, lookup=lookup, lookup_col="_v",
                              value_col="c.d")
    assert rows(plan.table) == [(1, "a", "v1"), (2, "b", "v2")]
    assert plan.changes.columns == ["_part_l", f"old_{set_col}", f"new_{set_col}"]


@pytest.mark.parametrize("cascade", [False, True])
def test_repeated_reservations_add_no_invoice(spark, cascade):
    resv = spark.createDataFrame([(10, "x@x", "M2"), (10, "y@x", "M1"), (10, "z@x", "M2"), (11, None, None), (None, None, "M5")],
                                 "id long, customer_email string, member_id string")
    invoices = spark.createDataFrame([(1, 10, "M1"), (2, 10, None), (3, 11, "M3"), (4, None, "M4"), (5, 10, "M2")],
                                     "id long, reservation_id long, customer_id string")
    trans = resv
    job = AssociationRepair(spark.createDataFrame([], "id string, email string"), trans, resv, invoices)
    plan = job.update_invoices(cascade)
    assert rows(plan.table) == [(1, 10, "M2"), (2, 10, "M1"), (3, 11, "M3"), (4, None, "M5"), (5, 10, "M1")]


def test_equal_rows_of_a_split_key_are_dealt_by_the_tables_key(spark):
    """Rows that differ in their key alone take different parts."""
    left = spark.range(400).selectExpr("id", "true AS _k_null", "'' AS _k_val")
    right = spark.createDataFrame([(True, "", 1)], "_k_null boolean, _k_val string, v int")
    out = skew_join(left, right, ["_k_null", "_k_val"], "left", unique_right=True, deal_by=["id"],
                    policy=SkewPolicy(placeholder_parts=8))
    assert out.count() == 400 and out.where("v = 1").count() == 400


def test_lower_goes_by_code_point(spark):
    texts = {"ÉAΣ": "éaσ", "İ": "i", "ΑΣ ΑΣ": "ασ ασ", "ABCxyz": "abcxyz", "ÀÖØÞ": "àöøþ", "ЖЯ": "жя", "ß": "ß", "ς": "ς",
             None: None, "": ""}
    df = spark.createDataFrame([(k, v) for k, v in texts.items()], "a string, b string")
    got = {r.a: r.c for r in df.select("a", sanitize_email("a").alias("c")).collect()}
    assert got == texts


def test_lower_stays_in_generated_code(spark):
    plan = spark.createDataFrame([("A",)], "a string").select(sanitize_email("a"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
