"""Plan shape of every registered query (final adaptive plan at a given scale):
shuffles, broadcasts, windows, single-partition exchanges, Python nodes.
Prints a markdown table (plans of lineage cuts inside a query are separate
jobs and not included).

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stridelake.plans import catalogue  # noqa: E402
from stridelake.session import get_session  # noqa: E402


def shape(plan: str) -> dict:
    lines = plan.splitlines()
    return {
        "shuffles": sum(1 for x in lines if re.search(r"\bExchange (hash|range|round|Single)", x)
                        and "Broadcast" not in x),
        "reused": sum(1 for x in lines if "ReusedExchange" in x),
        "broadcasts": sum(1 for x in lines if "BroadcastExchange" in x),
        "windows": sum(1 for x in lines if re.search(r"^\W*Window\b", x)),
        "single": sum(1 for x in lines if "SinglePartition" in x),
        "python": sum(1 for x in lines if re.search(r"MapInPandas|EvalPython|InPandas", x)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("plan-report", master="local[8]", shuffle_partitions=8)
    print("| query | shuffles | reused | broadcasts | windows | single-partition | python |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in catalogue.QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['windows']} "
              f"| {s['single']} | {s['python']} |")


if __name__ == "__main__":
    main()
