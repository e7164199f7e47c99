"""Times the registered queries; prints one line of JSON.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores,
BENCH_QUERIES a comma-separated choice. Each query is timed from an idle session to
its last row, which goes to a sink that discards it. A small query runs first, so
that the start of the session is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import all_queries  # noqa: E402
from subscore.session import build_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    partitions = None if cpus == "*" else int(cpus)
    spark = build_session(
        "bench", f"local[{cpus}]", partitions, **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["add_shifted_month"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen or queries:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
