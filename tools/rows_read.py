"""Rows read and shuffled by the jobs, from Spark's event log: with the default
settings (placeholder keys dealt to parts) and with all splitting off.

Usage: python tools/rows_read.py [sf_dir]    (prints a markdown table)

The fixture views are first copied to parquet, and broadcast joins are off, so
every join shuffles as it does on tables too large to broadcast.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from idbridge.plans.pipelines import AssociationRepair, TransactionOrphans, UserMapping  # noqa: E402
from idbridge.session import build_session  # noqa: E402
from idbridge.sources import FixtureTables, ParquetTables  # noqa: E402

MODES = {"default": "0", "off": "1"}  # idbridge.skew.placeholderParts


def jobs(spark, src) -> dict:
    p1 = UserMapping.from_tables(spark, src, src)
    p2 = AssociationRepair.from_tables(spark, src)
    p3 = TransactionOrphans.from_tables(spark, src, 1998)
    return {"mapped_users": lambda: p1.mapped, "dup_mapped": lambda: p1.dup_mapped,
            "update_users": lambda: p1.update().table, "update_users_stable": lambda: p1.update(stable=True).table,
            "remap_transactions": lambda: p2.remap_transactions,
            "remap_invoices_cascade": lambda: p2.remap_invoices(cascade=True),
            "update_transactions": lambda: p2.update_transactions().table,
            "update_invoices": lambda: p2.update_invoices().table,
            "update_invoices_cascade": lambda: p2.update_invoices(cascade=True).table,
            "unmatched_transaction_emails": lambda: p3.unmatched}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="rows-read-")
    os.makedirs(f"{scratch}/log")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}/log",
                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                 "spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name in ("members", "users", "transactions", "reservations", "invoices"):
        FixtureTables(sf_dir).table(spark, name).write.parquet(f"{scratch}/in/{name}")
    for mode, parts in MODES.items():
        spark.conf.set("idbridge.skew.placeholderParts", parts)
        for name, make in jobs(spark, ParquetTables(f"{scratch}/in")).items():
            df = make()
            spark.sparkContext.setJobDescription(f"measure {name} {mode}")
            df.write.format("noop").mode("overwrite").save()
            spark.sparkContext.setJobDescription("")
    spark.stop()

    of_stage, read, shuffled, stages = {}, defaultdict(int), defaultdict(int), defaultdict(set)
    for file in os.listdir(f"{scratch}/log"):
        with open(f"{scratch}/log/{file}") as log:
            for line in log:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    what = (e.get("Properties") or {}).get("spark.job.description", "")
                    if what.startswith("measure "):
                        of_stage.update(dict.fromkeys(e["Stage IDs"], tuple(what.split()[1:])))
                elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in of_stage:
                    key, m = of_stage[e["Stage ID"]], e.get("Task Metrics") or {}
                    read[key] += m.get("Input Metrics", {}).get("Records Read", 0)
                    shuffled[key] += m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
                    stages[key].add(e["Stage ID"])
    print(f"\n## Rows read and shuffled at {os.path.basename(sf_dir)}, no key hot\n")
    print("From the event log (`tools/rows_read.py`): default settings / splitting off, broadcasts off.\n")
    print("| query | rows read | shuffled rows | stages |\n| --- | --- | --- | --- |")
    for name in dict.fromkeys(n for n, _ in read):
        a, b = (name, "default"), (name, "off")
        print(f"| {name} | {read[a]:,} / {read[b]:,} | {shuffled[a]:,} / {shuffled[b]:,} | "
              f"{len(stages[a])} / {len(stages[b])} |")


if __name__ == "__main__":
    main()
