"""Times every catalog query; prints one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated query names (default all)
BENCH_RUNS     runs per query, the best counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from almenara.plans.catalog import QUERIES  # noqa: E402
from almenara.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(
        "almenara-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__sql__sources__parallelPartitionDiscovery__parallelism=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["daily_totals"](spark, sf_dir).collect()  # start-up is not a query's time
    seconds: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
        print(f"{name} {best:.3f}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "catalog queries, total of best runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
