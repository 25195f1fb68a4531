"""Write the final (post-AQE) physical plans of the headline queries to docs/PLANS.md.

usage: python tools/explain_plans.py [--sf-dir DIR]
Each query is executed once (noop sink) so the adaptive plan is final, then
the operator lines of its plan are summarised: joins, exchanges, aggregates, scans.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"(Join|Exchange|HashAggregate|ObjectHashAggregate|SortAggregate|Window|QueryStage|"
                  r"FileScan|Generate|TakeOrdered|Subquery|ArrowEvalPython|FlatMapGroupsInPandas)")


def summarise(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
            out.append(line.rstrip()[:220])
    return out


def main():
    from bench import HEADLINE
    from lakecube.registry import QUERIES
    from lakecube.session import get_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "docs", "PLANS.md"))
    args = ap.parse_args()
    spark = get_session("local[8]", shuffle_partitions=16)
    lines = ["# Final physical plans of the headline queries", "",
             f"Generated by `tools/explain_plans.py` on `{args.sf_dir}` (local[8], AQE on). Only operator lines "
             "are kept: joins, exchanges, aggregates, windows, scans. `*(n)` marks whole-stage codegen.", ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, args.sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {name}", "", "```"] + summarise(plan) + ["```", ""]
    os.makedirs(os.path.dirname(args.out), exist_ok=True)
    with open(args.out, "w") as f:
        f.write("\n".join(lines))
    print(args.out)


if __name__ == "__main__":
    main()
