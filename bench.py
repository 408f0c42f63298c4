"""Time the registered queries and print one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated)
a subset. Each query runs once to warm the JVM up, then three times (BENCH_RUNS); the median
counts. Results go to the no-op sink, so every column of every row is computed. The
training-data operators are measured by the check tool, not here.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pagemill.plans.queries import QUERIES  # noqa: E402
from pagemill.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in wanted or QUERIES:
        runs = []
        for _ in range(1 + int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs[1:]), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
