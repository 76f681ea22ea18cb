"""Write the physical plans of the headline queries to PLANS.md.

Usage: python tools/show_plans.py [SF_DIR]
The plans are the initial adaptive plans: at run time AQE may still coalesce
partitions or turn a sort-merge join into a broadcast join once it has
measured a side.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ("silver", "kpi_courier", "quality", "dedup_shipments", "orphans")


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    text = qe.executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from lastmile.plans.catalog import QUERIES as ALL
    from lastmile.session import build_session
    spark = build_session("local[4]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/show_plans.py` on `{sf_dir}` (local[4]); expression ids removed.",
           "Initial adaptive plans: AQE may still coalesce partitions or switch a join at run time.",
           "Long projections are cut at 400 characters per line.", ""]
    for name in QUERIES:
        df = ALL[name](spark, sf_dir)
        plan = _plan(df)
        lines = [ln if len(ln) <= 400 else ln[:400] + " ..." for ln in plan.splitlines()]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
