"""Print the final (post-AQE) physical plan of registered queries, condensed
to the operators that matter for scale (exchanges, joins, aggregates,
windows, generators, scans with their pushed filters and read schema).

Usage: python tools/show_plans.py SF_DIR name [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contrail.plans.catalog import queries  # noqa: E402
from contrail.session import get_session  # noqa: E402

KEEP = ("Exchange", "Join", "Aggregate", "Window", "Scan", "Expand", "Generate", "AQEShuffleRead",
        "BroadcastExchange", "TakeOrdered", "Union", "Sort ", "LocalTableScan")


def condensed(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*\]", "", line)
        if any(k in line for k in KEEP):
            out.append(line[:200])
    return out


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = get_session("local[8]", 8)
    for name in names:
        df = queries()[name](spark, sf_dir)
        df.collect()  # runs this QueryExecution, so AQE's final plan is available
        print(f"### {name}\n```")
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        print("\n".join(condensed(text)))
        print("```\n")


if __name__ == "__main__":
    main()
