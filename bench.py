"""Time the workload's queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores), BENCH_QUERIES
(comma-separated, default all).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataline.session import build_session  # noqa: E402
from strataline.workload.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    spark = build_session("bench", cores=cpus, shuffle_partitions=int(cpus))
    # One untimed query starts the executors, the code generator and the file readers.
    QUERIES["dim_date"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in chosen:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]:.2f}s", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
