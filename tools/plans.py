"""Write PLANS.md: the physical plan shape of every registered query.

usage: python tools/plans.py [sf_dir]

Plans are taken with automatic broadcasts switched off (AQE and the static
threshold), i.e. the plan a large input gets; explicit broadcasts (bounded
calendar and geography, checked change batches) stay. Per query: exchanges,
broadcasts, windows, parquet scans with the columns they read and the filters
pushed into them, and any Python operator (there should be none).
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

SKIP = {  # these run writes/streams while building; their read plans are covered elsewhere
    "ingest_json_events", "direct_file_scan", "append_history", "reconcile_counts",
    "stream_file_once", "stream_upsert", "zorder_layout", "compact",
    "merge_newer_wins_small_batch", "profile_columns", "table_sample_rows", "create_table_twice",
    "namespace_selected", "overwrite_schema", "gate_failures", "extract_run", "ingest_malformed_json",
}
PY_OPS = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def main() -> None:
    from strata.plans.queries import REGISTRY
    from strata.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[4]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    out = ["# PLANS", "",
           "Physical plans of the registered queries with automatic broadcasts off (the plan a large",
           "input gets). Generated by `python tools/plans.py`; scans list each parquet table read",
           "with the number of columns it reads and the filters pushed into it.", "",
           "| query | exchanges | reused exchanges | broadcasts | windows | python ops | scans (columns read; pushed filters) |",
           "|---|---|---|---|---|---|---|"]
    for name, fn in REGISTRY.items():
        if name in SKIP or name.startswith("pipeline_") or name.endswith("_view"):
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet\]"
                           r".*?PushedFilters: \[([^\]]*)\]", plan)
        scan_txt = "; ".join(sorted({
            f"{t}({len(c.split(','))}{': ' + pf if pf else ''})" for c, t, pf in scans}))
        nodes = [re.sub(r"^[\s:+\-*()0-9]*", "", line) for line in plan.splitlines()]
        count = {k: sum(n.startswith(k) for n in nodes)
                 for k in ("Exchange ", "ReusedExchange", "BroadcastExchange", "Window ")}
        out.append(f"| `{name}` | {count['Exchange ']} | {count['ReusedExchange']} "
                   f"| {count['BroadcastExchange']} | {count['Window ']} "
                   f"| {sum(plan.count(p) for p in PY_OPS)} | {scan_txt} |")
    out += ["", "Not listed (they write or stream while being built; covered by tests): "
            + ", ".join(f"`{s}`" for s in sorted(SKIP)) + ", `pipeline_*` and the views."]
    open("PLANS.md", "w").write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
