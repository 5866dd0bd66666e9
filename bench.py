"""Run the registered queries once each and print one line of JSON.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (names, comma-separated) choose data, cores and queries.
"""

from __future__ import annotations

import json
import os
import time

from tillstream.plans.queries import registry
from tillstream.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    queries = registry()
    names = chosen.split(",") if chosen else list(queries)

    spark = local_session(cpus, app="tillstream-bench")
    # Start the executor threads and the code generator before the clock runs.
    queries["sales_per_day"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
