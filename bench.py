"""Time the queries: one untimed run, then the median of timed ones.

Settings by environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads),
BENCH_RUNS (timed runs), BENCH_QUERIES (comma-separated names, default all).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyhouse.queries import QUERIES  # noqa: E402
from tallyhouse.session import build_session  # noqa: E402


def run(query, spark, sf_dir: str) -> float:
    """Seconds to plan the query and produce every row and column of its result."""
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or list(QUERIES)
    spark = build_session(
        "bench", f"local[{cpus}]", cpus, {"spark.ui.enabled": "false", "spark.driver.memory": "6g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, sf_dir) for _ in range(runs)), 4)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median warm query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
