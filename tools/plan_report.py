"""Summarise the physical plan of every registered query (PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Plans are taken over the written clean tables (as production reports run).
The first table counts the initial AQE plans.  The second runs the queries
with joins with broadcasts switched off, as for a catalogue and a customer
table too large for them, and counts the final plans: what adaptive execution
left of the shuffles, which it reused, and which partitions it split.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {
    "shuffles": r"^\(\d+\) Exchange$",
    "broadcasts": r"^\(\d+\) BroadcastExchange$",
    "smj": r"^\(\d+\) SortMergeJoin",
    "bhj": r"^\(\d+\) BroadcastHashJoin",
    "hash_agg": r"^\(\d+\) HashAggregate",
    "sort_agg": r"^\(\d+\) SortAggregate",
    "windows": r"^\(\d+\) Window",
    "python": r"^\(\d+\) (MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)",
    "cartesian": r"^\(\d+\) (CartesianProduct|BroadcastNestedLoopJoin)",
}
FINAL = {
    "shuffles": r"[^a-zA-Z]Exchange [a-zA-Z]",
    "reused": r"ReusedExchange",
    "smj": r"SortMergeJoin",
    "skew_joins": r"SortMergeJoin\(skew=true\)",
    "split_reads": r"AQEShuffleRead [a-z ]*skewed",
    "coalesced_reads": r"AQEShuffleRead [a-z ]*coalesced",
    "sorts": r"[^a-zA-Z]Sort \[",
    "scans": r"FileScan",
}


def summarise(plan: str) -> dict:
    lines = [ln.strip() for ln in plan.splitlines()]
    out = {k: sum(1 for ln in lines if re.match(p, ln)) for k, p in KINDS.items()}
    schemas = [ln for ln in lines if ln.startswith("ReadSchema:")]
    out["scan_cols"] = ",".join(str(s.count(":") - 1) for s in schemas)
    out["pushed"] = sum(1 for ln in lines if ln.startswith("PushedFilters:") and ln != "PushedFilters: []")
    out["single_partition"] = sum(1 for ln in lines if "SinglePartition" in ln)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from priceloom.plans import registry
    from priceloom.plans.pipeline import testdata_tables
    from priceloom.session import build_session
    spark = build_session("local[8]", 16)
    t = testdata_tables(spark, sf_dir)
    print(f"# Physical plans ({os.path.basename(sf_dir)}, initial AQE plans over the written clean tables)\n")
    print("Counts per query: shuffle exchanges, broadcast exchanges, sort-merge / broadcast hash joins, "
          "hash / sort aggregates, windows, Python operators, cartesian products, columns read per scan, "
          "scans with pushed filters, and SinglePartition exchanges.\n")
    cols = ["shuffles", "broadcasts", "smj", "bhj", "hash_agg", "sort_agg", "windows", "python", "cartesian",
            "scan_cols", "pushed", "single_partition"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, fn in registry.catalogue().items():
        buf = io.StringIO()
        with redirect_stdout(buf):
            fn(t).explain("formatted")
        s = summarise(buf.getvalue())
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    # a partition beyond 256 KB and 1.5 times the median counts as skewed, for tables of this size
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    print("\n# Final plans of the queries with joins, without broadcasts\n")
    print("Shuffles and reused ones, sort-merge joins and those split for skew, reads of split and of coalesced partitions, "
          "sorts, scans.  Partitions count as skewed from 256 KB, to show the splits at this scale.\n")
    print("| query | " + " | ".join(FINAL) + " |")
    print("| --- | " + " | ".join("---" for _ in FINAL) + " |")
    for name, fn in registry.catalogue().items():
        df = fn(t)
        if "Join" not in df._jdf.queryExecution().optimizedPlan().toString():
            continue
        df.toArrow()
        # the plan as run, with those of its subqueries
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = "".join(re.findall(r"== Final Plan ==(.*?)== Initial Plan ==", plan, re.S))
        print(f"| {name} | " + " | ".join(str(len(re.findall(p, final))) for p in FINAL.values()) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
