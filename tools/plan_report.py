"""Summarise the physical plans of the headline queries into PLANS.md:
shuffles, broadcasts, join strategies, windows, scans with their pruned read
schema and pushed filters.  Plans are the initial adaptive plans (AQE may
still turn a sort-merge join into a broadcast join or coalesce partitions at
run time, but never adds a shuffle).

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from saleslake.plans import checks  # noqa: E402
from saleslake.session import build_session  # noqa: E402
from saleslake.sources.tables import Tables  # noqa: E402

NODES = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "Window", "HashAggregate", "ObjectHashAggregate", "Expand", "Scan ExistingRDD", "BroadcastNestedLoopJoin",
         "CartesianProduct")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print("# Plan shapes of the headline queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf}`. Counts are physical operators of the initial "
          "adaptive plan (`Exchange` = shuffle; `Scan ExistingRDD` = a reliable checkpoint being read). "
          "AQE can still turn a sort-merge join into a broadcast join, or coalesce partitions, once it has "
          "measured a side. Queries that assign dense keys (SCD2 inserts, fact keys) carry a small offsets branch: "
          "a count per partition of the frozen rows, a running sum over those few rows (one row per partition, "
          "so the single-partition window is bounded by the partition count) and its broadcast back.\n")
    print("| query | " + " | ".join(n.replace("Scan ExistingRDD", "checkpoint read") for n in NODES) + " |")
    print("|---|" + "---|" * len(NODES))
    scans = {}
    for name in HEADLINE:
        df = checks.CHECKS[name](Tables(spark, sf))
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        head = [ln for ln in text.splitlines() if re.match(r"^\(\d+\) ", ln)]
        counts = []
        for n in NODES:
            pat = re.compile(r"^\(\d+\) " + re.escape(n) + r"(\s|$)")
            counts.append(sum(1 for ln in head if pat.match(ln)))
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
        blocks = re.split(r"\n(?=\(\d+\) )", text)
        for b in blocks:
            if b.startswith("(") and "Scan parquet" in b.splitlines()[0]:
                rs = re.search(r"ReadSchema: (.*)", b)
                pf = re.search(r"PushedFilters: (.*)", b)
                loc = re.search(r"Location: .*\[(.*?)\]", b)
                table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
                scans.setdefault(table, set()).add(
                    (rs.group(1) if rs else "", pf.group(1) if pf else ""))
    print("\n## Parquet scans (distinct read schemas and pushed filters seen)\n")
    for table in sorted(scans):
        for rs, pf in sorted(scans[table]):
            print(f"- `{table}`: reads `{rs}`; pushed `{pf}`")
    spark.stop()


if __name__ == "__main__":
    main()
