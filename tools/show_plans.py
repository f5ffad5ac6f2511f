"""Summarize executed plans of the headline queries: scans (columns read,
pushed filters), exchanges, joins, aggregates, Python stages.

    python tools/show_plans.py [sf_dir] > PLANS.md

The broadcast threshold is lowered to 64 KB so only the fixed-size
dimensions (nation, region) and genuinely tiny intermediates broadcast — the
shape a 100 TB run gets, where the big tables are far over any threshold.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans import catalog  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

QUERIES = ["fact_transactions", "agg_monthly_revenue", "anomaly_score", "dq_failure_counts", "ai_insights_kpi", "rag_topk", "vector_topk"]
OPS = r"\b(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|ObjectHashAggregate|HashAggregate|SortAggregate|WindowGroupLimit|Window|MapInPandas|ArrowEvalPython|BatchEvalPython|Expand|Generate)\b"


def summarize(plan: str) -> list[str]:
    out = []
    if "== Final Plan ==" in plan:
        plan = re.split(r"\n\+- == Initial Plan ==", plan.split("== Final Plan ==", 1)[1])[0]
    for line in plan.split("\n"):
        m = re.search(r"FileScan parquet .*?PushedFilters: \[([^\]]*)\].*?ReadSchema: (\S+)", line)
        if m:
            out.append(f"- scan `{m.group(2)}` pushed: [{m.group(1)[:120]}]")
    ex = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)
    kinds = Counter(re.sub(r"#\d+L?", "", e).split("(")[0] for e in ex)
    out.append(f"- exchanges: {dict(kinds)}")
    ops = Counter(re.findall(OPS, plan))
    out.append(f"- operators: {dict(ops)}")
    if "skew=true" in plan:
        out.append("- AQE split a skewed join partition")
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64k")
    print(f"# Executed plans ({os.path.basename(sf_dir)}, broadcast threshold 64 KB, AQE on)\n")
    print("Generated by `tools/show_plans.py`.\n")
    for name in QUERIES:
        df = catalog.QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n")
        for line in summarize(plan):
            print(line)
        print()


if __name__ == "__main__":
    main()
