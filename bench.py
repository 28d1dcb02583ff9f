"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is forced end to end with the ``noop`` sink (full computation, nothing
collected). An untimed warm-up pass runs every query once on a smaller data set first
(sf0.01: JIT and code generation), then each query is timed once at ``$BENCH_SF_DIR``. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = [
    # customer profile (the reference's full-load report)
    "q00_quality_summary", "q01_null_counts", "b01_top_countries", "b05_industry_segments",
    "b13_growth", "b15_email_domains", "b17_phone_patterns", "b18_top_hosts", "b21_describe_lineitem",
    "p06_validate",
    # vector search and statistics
    "v03_batch_search", "v07_category_counts", "v11_category_matrix", "v12_search_summary",
    # receipt text → records, stores, spending, questions
    "r14_parse", "d03_receipt_store", "a05_totals", "a06_top_stores", "a11_daily_spending",
    "a19_receipts_page", "n04_intent", "n06_question_answers",
    # incremental
    "t01_running_counts",
]


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16))
    queries = catalog.queries()
    # warm-up on the smallest data: JVM JIT and whole-stage codegen for every timed query
    warm_dir = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.01"))
    for name in names:
        _force(queries[name](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir))
    times = {}
    for name in names:
        t0 = time.perf_counter()
        _force(queries[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
