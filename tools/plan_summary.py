"""Summarise the physical plan of every report (initial adaptive plan) as a Markdown table.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marketlens.registry import REPORTS  # noqa: E402
from marketlens.session import get_session  # noqa: E402


PATTERNS = [r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", r"BroadcastExchange",
            r"SortMergeJoin", r"BroadcastHashJoin", r"HashAggregate\(", r" Window \[", r"Expand \["]


def count(p, pat):
    return len(re.findall(pat, p))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    print("# Physical plans of the reports\n")
    print(f"Initial adaptive plans at `{sf}` with the default materialization (a relation read by")
    print("several branches is checkpointed once and appears as `Scan ExistingRDD`). Broadcasts come")
    print("from Spark's size check against")
    print("`autoBroadcastJoinThreshold` on this small input; at scale those joins stay shuffle joins")
    print("unless AQE measures a small side. Regenerate with `python tools/plan_summary.py`.\n")
    print("| Report | Shuffle exchanges | Broadcast exchanges | Sort-merge joins | Broadcast joins | "
          "Hash aggregates | Windows | Expand | Scans | Scans with pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in REPORTS.items():
        p = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet[^\n]*", p) + re.findall(r"Scan ExistingRDD[^\n]*", p)
        pushed = [s for s in scans if re.search(r"PushedFilters: \[[^\]]*(GreaterThan|LessThan|EqualTo|In\()", s)]
        cells = [count(p, pat) for pat in PATTERNS] + [len(scans), len(pushed)]
        print(f"| `{name}` | " + " | ".join(str(c) for c in cells) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
