"""Bench: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected). The clean/quarantine split is timed as the
real one-pass partitioned write. The incremental pipeline (landing files →
Bronze → Silver → Gold → KPIs through availableNow streams) is timed
separately and reported as ``incremental_pipeline``. ``BENCH_EVENT_LOG=dir``
writes Spark's event log there for stage and task times. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.operators.quality import write_split  # noqa: E402
from ledgerline.plans import catalog  # noqa: E402
from ledgerline.plans.lakehouse import Lakehouse  # noqa: E402
from ledgerline.session import local_session  # noqa: E402
from ledgerline.streaming.runner import Layout, Runner  # noqa: E402
from tools.land_testbed import land_testbed  # noqa: E402

HEADLINE = [
    "fact_transactions",
    "agg_monthly_revenue",
    "anomaly_score",
    "flagged_return_customers",
    "dq_audit_report",
    "ai_insights_kpi",
    "rag_topk",
    "rag_answer",
    "vector_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # optional: Spark's event log (stage / task times) into a scratch folder
    log_dir = os.environ.get("BENCH_EVENT_LOG")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="ledgerline-bench", extra=extra)
    out_root = tempfile.mkdtemp(prefix="ledgerline-bench-")

    # warm-up: JVM, parquet footers, Python workers (arrow / mapInPandas)
    for name in ("kpi_revenue", "vector_topk"):
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    write_split(Lakehouse.from_testbed(spark, sf_dir).transactions_base, f"{out_root}/transactions_split")
    times["clean_quarantine_transactions"] = round(time.perf_counter() - t0, 3)

    # incremental pipeline: raw files → Bronze → Silver → Gold → KPIs (landing not timed)
    pipeline = None
    if os.environ.get("BENCH_PIPELINE", "1") == "1":
        landing = f"{out_root}/landing"
        rows = land_testbed(spark, sf_dir, landing)
        t0 = time.perf_counter()
        Runner(spark, Layout(f"{out_root}/lake"), checkpoint_root=f"{out_root}/ck").run(landing)
        sec = time.perf_counter() - t0
        pipeline = {"raw_rows": rows, "sec": round(sec, 3), "rows_per_sec": round(rows / sec)}

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "incremental_pipeline": pipeline,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
