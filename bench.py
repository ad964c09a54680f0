"""Benchmark: run the headline catalogue queries on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full through the no-op sink (no collect to the
driver). One warm-up pass over all queries, then each query is timed
$BENCH_REPEAT times (default 3) and the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stridelake.plans import catalogue  # noqa: E402
from stridelake.session import get_session  # noqa: E402

HEADLINE = [
    "trial_events", "trial_results", "motion_metrics", "state_runs", "spaced_peaks",
    "quality_tags", "dedup_flags", "pose_flags", "interpolate_marks", "state_fill",
    "session_samples", "chunk_index", "ranked_results", "parse_lines", "path_metadata",
]


def run(spark, name: str, sf: str) -> float:
    t = time.perf_counter()
    catalogue.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session("stridelake-bench", master=f"local[{cpus}]",
                        shuffle_partitions=int(cpus) * 2)
    for n in names:  # warm-up (JIT, file listing caches)
        run(spark, n, sf)
    times = {n: round(statistics.median(run(spark, n, sf) for _ in range(repeat)), 3)
             for n in names}
    sfname = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sfname, "cpus": int(cpus),
                      "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
