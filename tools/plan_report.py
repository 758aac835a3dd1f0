"""Summarise the physical plan of every registered query (before execution, AQE's initial plan).

usage: python tools/plan_report.py [sf_dir] > docs/PLANS.md
Counts shuffles / joins / windows and shows what reaches the fact scan
(read schema, pushed filters, partition filters).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.plans.queries import registry  # noqa: E402
from shelfcast.schemas import FACT_COLS  # noqa: E402
from shelfcast.session import local_session  # noqa: E402

SKIP = {"gradient_boosting", "model_scorecard_all", "gradient_boosting_rows"}


def _count(plan: str, pat: str) -> int:
    return len(re.findall(pat, plan))


def _scan_info(plan: str) -> str:
    out = []
    for line in plan.split("\n"):
        if "FileScan parquet" not in line:
            continue
        rs = re.search(r"ReadSchema: struct<([^>]*)", line)
        fields = {f.split(":")[0] for f in rs.group(1).split(",")} if rs else set()
        partitioned_by_state = "state_id" in line.split("ReadSchema")[0] if rs else False
        if not rs or not fields <= set(FACT_COLS) or not (partitioned_by_state or "units_sold" in fields):
            continue
        pf = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
        pu = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        cols = rs.group(1).count(":") if rs else "?"
        bits = [f"{cols} cols"]
        if pf and pf.group(1):
            bits.append("partition: " + re.sub(r"#\d+", "", pf.group(1)))
        if pu and pu.group(1):
            bits.append("pushed: " + pu.group(1))
        out.append(", ".join(bits))
    return "; ".join(dict.fromkeys(out)) or "-"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan details
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` (AQE initial plans; AQE may still turn a "
          "sort-merge join into a broadcast join, or coalesce partitions, from runtime sizes).  "
          "Scans of the published fact only; `cols` = columns read out of 23.\n")
    print("| query | shuffles | broadcast | SMJ | BHJ | window | expand | python | fact scan |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in registry().items():
        if name in SKIP:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        print(f"| {name} | {_count(plan, r'Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning')} "
              f"| {_count(plan, r'BroadcastExchange')} | {_count(plan, r'SortMergeJoin')} | {_count(plan, r'BroadcastHashJoin')} "
              f"| {_count(plan, r'\bWindow ')} | {_count(plan, r'Expand ')} "
              f"| {_count(plan, r'ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas')} | {_scan_info(plan)} |")


if __name__ == "__main__":
    main()
