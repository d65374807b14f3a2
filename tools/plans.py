"""Summarise the physical plan of every registered query.

Usage: python tools/plans.py [sf_dir] > docs/PLANS.md

Two columns of settings: as planned on the test data, and with broadcast
joins off (``autoBroadcastJoinThreshold=-1``), which is how the plans look
when every table is too large to broadcast. Counts come from the initial
physical plan, before adaptive execution changes it.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from idbridge.plans.catalog import QUERIES  # noqa: E402
from idbridge.session import build_session  # noqa: E402


def summary(df) -> dict:
    initial = df._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"== Initial Plan ==(.*)", initial, re.S)
    text = m.group(1) if m else initial
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if p})
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", text)),
        "broadcasts": text.count("BroadcastExchange"),
        "smj": text.count("SortMergeJoin"),
        "bhj": text.count("BroadcastHashJoin"),
        "group_limit": "WindowGroupLimit" in text and "Partial" in text,
        "split": "_part_l" in text,
        "pushed": "; ".join(p for p in pushed if "IsNotNull" not in p or "," in p)[:90],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print(f"# Physical plans at {os.path.basename(sf_dir)}\n")
    print("Generated by `tools/plans.py`. Counts are from the initial physical plan:")
    print("hash/range shuffles, broadcast exchanges, sort-merge and broadcast hash joins;")
    print("`limit` = map-side `WindowGroupLimit`; `split` = placeholder keys dealt to parts.\n")
    rows = {}
    for mode, conf in [("local", "10485760b"), ("no-broadcast", "-1")]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        for name, fn in QUERIES.items():
            rows.setdefault(name, {})[mode] = summary(fn(spark, sf_dir))
    print("| query | local: shuffles / bcast / smj / bhj | no-broadcast: shuffles / smj / split / limit | pushed filters |")
    print("| --- | --- | --- | --- |")
    for name, r in rows.items():
        a, b = r["local"], r["no-broadcast"]
        print(f"| {name} | {a['shuffles']} / {a['broadcasts']} / {a['smj']} / {a['bhj']} | "
              f"{b['shuffles']} / {b['smj']} / {'yes' if b['split'] else 'no'} / {'yes' if b['group_limit'] else 'no'} | "
              f"{a['pushed'] or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
