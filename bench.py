"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.  Each query is forced with a ``noop`` write (the
whole plan runs, nothing is collected to the driver)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saleslake.plans import checks  # noqa: E402
from saleslake.session import build_session  # noqa: E402
from saleslake.sources.tables import Tables  # noqa: E402

HEADLINE = [
    "extract_sales", "category_rollup", "fact_load", "regional_summary", "product_rankings",
    "daily_summary", "customer_segments", "scd2_product", "scd2_customer", "category_rules",
    "supplier_enrich", "staging_metrics", "day_ratio_gate", "dq_results", "audit_pk", "entry",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="saleslake-bench")
    spark.range(1000).selectExpr("sum(id)").collect()            # JVM warm-up
    times, failed = {}, []
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            df = checks.CHECKS[name](Tables(spark, sf_dir))
            df.write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - a failing query is reported, not hidden behind a missing line
            times[name] = None
            failed.append(name)
            print(f"{name}: FAILED {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            continue
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir.rstrip("/"))
    out = {"metric": "headline_queries_total", "value": round(sum(v for v in times.values() if v is not None), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
