"""Time the queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regweave.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def seconds(query, spark, sf_dir: str) -> float:
    """Plan and run a query, every column of every row computed."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus, app="bench", memory=os.environ.get("BENCH_MEMORY", "16g"))
    for warm in ("raw_counts", "crosswalk"):  # class loading and JIT, not queries
        seconds(QUERIES[warm], spark, sf_dir)
    times = {}
    for name in names:
        times[name] = round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
        print(f"{name:24} {times[name]:7.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
