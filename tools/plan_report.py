"""Write PLANS.md: a summary of the physical plan of each headline query.

Usage: python tools/plan_report.py [sf_dir] [--all]   (default /root/testdata/sf0.1)
The static plan (AQE off) is summarised so the counts do not depend on
runtime statistics; AQE re-plans joins and partition counts at run time.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tessera.plans.registry import all_queries  # noqa: E402
from tessera.session import get_session  # noqa: E402


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    single = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
            child = lines[i + 1].strip().lstrip("+- :*()0123456789").split("(")[0] if i + 1 < len(lines) else ""
            single.append(child)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    return {
        "shuffles": sum("Exchange hashpartitioning" in x or "Exchange rangepartitioning" in x for x in lines),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "nested_loop": plan.count("BroadcastNestedLoopJoin"),
        "cartesian": plan.count("CartesianProduct"),
        "window_group_limit": "WindowGroupLimit" in plan,
        "single_partition_inputs": ", ".join(sorted(set(single))) or "-",
        "python": any(k in plan for k in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")),
        "pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "scans": len(scans),
        "widest_scan_cols": max((len(s.split(",")) for s in scans), default=0),
    }


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    spark = get_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    qs = all_queries()
    out = ["# PLANS", "",
           f"Static physical plans (AQE off) of the headline queries on `{sf}`, generated by",
           "`tools/plan_report.py`.  `single-partition inputs` names the operator feeding each",
           "`Exchange SinglePartition`: only one-row aggregates (scalars, quantiles) and",
           "per-chunk summaries are allowed there, never raw rows.", "",
           "| query | shuffles | broadcast joins | sort-merge joins | nested-loop (bounded side) | cartesian | "
           "WindowGroupLimit | single-partition inputs | Python | scans | widest scan (cols) |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name in HEADLINE:
        p = qs[name].build(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarise(p)
        out.append(f"| {name} | {s['shuffles']} | {s['broadcast_joins']} | {s['sort_merge_joins']} | {s['nested_loop']} | "
                   f"{s['cartesian']} | {'yes' if s['window_group_limit'] else '-'} | {s['single_partition_inputs']} | "
                   f"{'yes' if s['python'] else '-'} | {s['scans']} | {s['widest_scan_cols']} |")
    out += ["", "Nested-loop joins in these plans attach one-row aggregates (`attach_scalars`:",
            "totals, quantile boundaries) or the size-checked query set of exact vector search.",
            "Python appears only in the Arrow-batched chunker (`txt05`)."]
    if "--all" in sys.argv:
        out += ["", "## Every registered query", "",
                "| query | shuffles | BHJ | SMJ | BNLJ | cartesian | WGL | single-partition inputs | Python |",
                "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
        for name in sorted(qs):
            try:
                p = qs[name].build(spark, sf)._jdf.queryExecution().executedPlan().toString()
            except Exception as e:  # noqa: BLE001
                out.append(f"| {name} | plan error: {type(e).__name__} | | | | | | | |")
                continue
            s = summarise(p)
            out.append(f"| {name} | {s['shuffles']} | {s['broadcast_joins']} | {s['sort_merge_joins']} | "
                       f"{s['nested_loop']} | {s['cartesian']} | {'yes' if s['window_group_limit'] else '-'} | "
                       f"{s['single_partition_inputs']} | {'yes' if s['python'] else '-'} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
