"""Run a reconciliation job from the command line.

    python -m idbridge map-users          --env envs.json --users web --members crm --out /lake/out
    python -m idbridge repair-associations --env envs.json --source crm --out /lake/out [--cascade]
    python -m idbridge transaction-orphans --env envs.json --source crm --out /lake/reports [--min-year 2026]
    python -m idbridge ticket-members     --env envs.json --tickets web --members crm [--out /lake/out]

``envs.json`` names the environments, one object each: either a database
(``{"kind": "postgres", "host": ..., "port": ..., "database": ..., "user": ...,
"password_env": "PG_PASS", "names": {"tickets": "sales.tickets"}}``) or a
parquet folder (``{"kind": "parquet", "root": "s3://lake/crm"}``). Passwords
are read from the named environment variables, never from the file.

A database environment may also hold ``"partitions"``: per table, how many
tasks read it: ``{"column": "id", "lower": 0, "upper": 1000000, "num": 64}`` for a
numeric column, ``{"column": "id", "cuts": ["4", "8", "c"]}`` or ``{"column": "id",
"hex": 64}`` for a string key, ``{"column": "id", "balanced": 64}`` for either, with cuts
that the database finds; ``"catalog_schema"``, to read through Spark's JDBC catalog,
where filters, DISTINCT and counts run inside the database; ``"fetch_size"``; and ``"max_connections"`` for writes.

Reports are written as parquet under ``--out``; updated tables are published as
new versions with a manifest. The session comes from the cluster's
``spark-submit`` settings.
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark.sql import SparkSession

from idbridge.plans.pipelines import (AssociationRepair, TicketOrphans, TransactionOrphans, UserMapping,
                                      apply_updates)
from idbridge.operators.sinks import publish
from idbridge.sources.readers import (BalancedRanges, CatalogTables, JdbcConnection, JdbcTables, KeyRanges,
                                      ParquetTables, Partitioning, Tables)

READING = ("names", "partitions", "fetch_size", "max_connections", "catalog_schema")
MAX_CONNECTIONS = 8


def connection_for(env: dict) -> JdbcConnection:
    return JdbcConnection(**{k: v for k, v in env.items() if k not in READING})


def _database(env: dict) -> tuple[JdbcConnection, dict, int]:
    if env["kind"] == "parquet":
        raise ValueError("--apply needs a database environment")
    return connection_for(env), env.get("names", {}), env.get("max_connections", MAX_CONNECTIONS)


def _partitions(spec: dict) -> Partitioning | KeyRanges | BalancedRanges:
    if "balanced" in spec:
        return BalancedRanges(spec["column"], spec["balanced"])
    if "hex" in spec:
        return KeyRanges.hex(spec["column"], spec["hex"])
    return KeyRanges(**spec) if "cuts" in spec else Partitioning(**spec)


def tables_for(env: dict) -> Tables:
    if env["kind"] == "parquet":
        return ParquetTables(env["root"], names=env.get("names"))
    if "catalog_schema" in env:
        return CatalogTables(connection_for(env), env["catalog_schema"], names=env.get("names"))
    return JdbcTables(connection_for(env), names=env.get("names"),
                      partitions={t: _partitions(p) for t, p in env.get("partitions", {}).items()},
                      fetch_size=env.get("fetch_size", 10000))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m idbridge")
    sub = p.add_subparsers(dest="job", required=True)
    m = sub.add_parser("map-users")
    m.add_argument("--users", required=True)
    m.add_argument("--members", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--null-safe", action="store_true")
    m.add_argument("--stable", action="store_true")
    m.add_argument("--apply", action="store_true", help="also update the users table inside its database")
    r = sub.add_parser("repair-associations")
    r.add_argument("--source", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--cascade", action="store_true")
    r.add_argument("--apply", action="store_true", help="also update the three tables inside their database")
    r.add_argument("--stage-to", help="database environment that gets the change lists as tables")
    t = sub.add_parser("transaction-orphans")
    t.add_argument("--source", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--min-year", type=int, default=2026)
    k = sub.add_parser("ticket-members")
    k.add_argument("--tickets", required=True)
    k.add_argument("--members", required=True)
    k.add_argument("--table", default="members")
    k.add_argument("--out")
    k.add_argument("--dedupe", action="store_true")
    k.add_argument("--one-statement", action="store_true",
                   help="stage the rows in the database and add them by one INSERT ... SELECT")
    for s in (m, r, t, k):
        s.add_argument("--env", required=True, help="JSON file of named environments")
        s.add_argument("--run-id", default=None)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    with open(args.env) as f:
        envs = json.load(f)
    spark = spark or SparkSession.builder.getOrCreate()
    run_id = args.run_id or uuid.uuid4().hex
    src = lambda name: tables_for(envs[name])

    if args.job == "map-users":
        job = UserMapping.from_tables(spark, src(args.users), src(args.members))
        reports = {"dup_members": job.dup_members, "dup_users": job.dup_users, "dup_mapped": job.dup_mapped}
        plan = job.update(null_safe=args.null_safe, stable=args.stable).materialized()
        paths = publish(spark, {**reports, "users": plan.table, "users_changes": plan.changes}, args.out, run_id=run_id)
        if args.apply:
            conn, names, n = _database(envs[args.users])
            apply_updates(spark, conn, {"users": plan}, names, n)
        return paths
    if args.job == "repair-associations":
        job = AssociationRepair.from_tables(spark, src(args.source))
        publish(spark, {"member_email_counts": job.member_email_counts}, f"{args.out}/reports", run_id=run_id)
        to = envs[args.stage_to] if args.stage_to else None
        conn, names, _ = _database(envs[args.source]) if args.apply else (None, None, 0)
        return job.run(args.out, cascade=args.cascade, run_id=run_id, stage_to=connection_for(to) if to else None,
                       apply_to=conn, names=names, max_connections=(to or {}).get("max_connections", MAX_CONNECTIONS))
    if args.job == "transaction-orphans":
        job = TransactionOrphans.from_tables(spark, src(args.source), args.min_year).materialized()
        return publish(spark, {"dup_members": job.dup_members, "dup_orphans": job.dup_orphans,
                               "unmatched": job.unmatched, "matched": job.matched}, args.out, run_id=run_id)
    # ticket-members
    members_env = envs[args.members]
    job = TicketOrphans.from_tables(spark, src(args.tickets), src(args.members), dedupe=args.dedupe)
    conn = None
    if members_env["kind"] != "parquet":
        conn = connection_for(members_env)
    if args.out:
        publish(spark, {"dup_members": job.dup_members, "dup_orphans": job.dup_orphans},
                f"{args.out}/reports", run_id=run_id)
    rows = job.run(conn, args.table, out_root=args.out, run_id=run_id,
                   max_connections=members_env.get("max_connections", MAX_CONNECTIONS),
                   members_src=members if isinstance(members := src(args.members), JdbcTables) else None, one_statement=args.one_statement)
    return {"inserted": rows.count()}


if __name__ == "__main__":
    print(json.dumps(main(), default=str))
