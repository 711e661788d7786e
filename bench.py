"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, BENCH_QUERIES (comma-separated names).
Each query is built and written to the no-op sink: one warm-up, then the median of the
runs, all queries alike.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from moodlake.catalog import QUERIES  # noqa: E402
from moodlake.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            once(name)
            seconds = [once(name) for _ in range(runs)]
            times[name] = round(statistics.median(seconds), 4)
            print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
        except Exception as exc:
            failed[name] = f"{type(exc).__name__}: {exc}"[:300]
            print(f"{name}: {failed[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total wall time of all queries, warm, median",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
