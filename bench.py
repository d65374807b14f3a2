"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up, then ``$BENCH_REPS`` times into Spark's
``noop`` sink (the whole plan executes, nothing is pulled to the driver);
the per-query figure is the median. Prints one JSON line. Of the queries that
write tables first (``indexed_``, ``rewritten_`` and so on) one of each kind is
timed, its writes included; ``$BENCH_QUERIES`` names others.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from idbridge.plans.catalog import QUERIES  # noqa: E402
from idbridge.session import build_session  # noqa: E402

WRITING = ("indexed_", "rewritten_", "ledger_", "prefiltered_", "factorised_", "ranked_")
TIMED = {"indexed_update_users", "rewritten_users", "ledger_dup_members", "prefiltered_unmatched_ticket_users",
         "factorised_mapped_users", "ranked_dup_mapped"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else [n for n in QUERIES if n in TIMED or not n.startswith(WRITING)]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-ckpt-"))

    timings: dict[str, float] = {}
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 4)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_query_medians", "value": round(sum(timings.values()), 4),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "reps": reps}))


if __name__ == "__main__":
    main()
