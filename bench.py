"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 3 timed runs after one warm-up; the median is reported), BENCH_QUERIES
(comma-separated names, default all).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimloom.queries import QUERIES  # noqa: E402
from claimloom.session import local_session  # noqa: E402


#: Each builds the same warehouse as warehouse_tables again; named in the output as left out, as are the llm queries.
REBUILT = {"q1_stored", "q3_stored", "quarter_stored"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [n for n in QUERIES if n not in REBUILT]
    spark = local_session(cores, "claimloom-bench", **{"spark.sql.shuffle.partitions": cores})
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "left_out": sorted(set(QUERIES) - set(seconds)) + ["queries of claimloom.llm (see the check tool's figures)"],
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
