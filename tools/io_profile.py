"""Records and bytes read and shuffled, ours and plain SQL (same Spark, same inputs).

    python tools/io_profile.py /root/testdata/sf0.1

Wall time at small scale is dominated by per-stage overhead; at 100 TB the input bytes read and
the bytes shuffled decide the run time.  Both are summed from task metrics in an event log
written to a fresh scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def totals(log_dir: str) -> dict[str, dict[str, int]]:
    out: dict[str, dict[str, int]] = {}
    group_of_job: dict[int, str] = {}
    group_of_stage: dict[int, str] = {}
    for f in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(f):
            continue
        for line in open(f, errors="ignore"):
            try:
                d = json.loads(line)
            except ValueError:
                continue
            ev = d.get("Event")
            if ev == "SparkListenerJobStart":
                g = (d.get("Properties") or {}).get("spark.jobGroup.id")
                group_of_job[d["Job ID"]] = g
                for sid in d["Stage IDs"]:
                    group_of_stage[sid] = g
            elif ev == "SparkListenerTaskEnd" and d.get("Task Metrics"):
                g = group_of_stage.get(d["Stage ID"])
                if g is None:
                    continue
                m = d["Task Metrics"]
                t = out.setdefault(g, {"input_bytes": 0, "input_records": 0, "shuffle_write_bytes": 0,
                                       "shuffle_write_records": 0, "tasks": 0})
                t["input_bytes"] += m.get("Input Metrics", {}).get("Bytes Read", 0)
                t["input_records"] += m.get("Input Metrics", {}).get("Records Read", 0)
                t["shuffle_write_bytes"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                t["shuffle_write_records"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
                t["tasks"] += 1
    return out


def main(sf_dir: str) -> None:
    from dataclasses import replace

    from loyalflow.config import FIXTURE_PROGRAM as P
    from loyalflow.operators import orders
    from loyalflow.plans.queries import QUERIES
    from loyalflow.session import build_session
    from loyalflow.sources.fixtures import fixture_sources
    from tools.plain_jobs import BASELINE, register

    log_dir = tempfile.mkdtemp(prefix="run-evlog-")
    spark = build_session("local[8]", 8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                                 "spark.eventLog.compress": "false"})
    src, sc = fixture_sources(spark, sf_dir), spark.sparkContext
    # the order lines as a table of their own, as a deployment has them: their derivation isn't counted
    fact = tempfile.mkdtemp(prefix="run-fact-")
    src.orders.write.mode("overwrite").parquet(fact)
    src = replace(src, orders=spark.read.parquet(fact))
    register(spark, sf_dir, src)
    work = {
        "last_order_ranked": (orders.last_order_ranked(src.orders, P), spark.table("last_order")),
        "last_order_details": (orders.last_order_details(src.orders, src.store, P), spark.table("details")),
        "member_order_single_pass": (orders.member_order_single_pass(src.orders, P), spark.table("metrics")),
        "migration_performance": (QUERIES["migration_performance"](spark, sf_dir), spark.table(BASELINE["migration_performance"])),
    }
    for name, pair in work.items():
        for kind, df in zip(("ours", "plain"), pair, strict=True):
            sc.setJobGroup(f"{name} {kind}", name)
            df.write.format("noop").mode("overwrite").save()
    spark.stop()
    found = totals(log_dir)
    print("| query | input records | shuffle records | shuffle MB | tasks |\n|---|---|---|---|---|")
    for name, t in found.items():
        if name:
            print(f"| `{name}` | {t['input_records']:,} | {t['shuffle_write_records']:,} | {t['shuffle_write_bytes'] / 1e6:.1f} | {t['tasks']} |")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
