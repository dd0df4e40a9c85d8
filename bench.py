"""Times the queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Every row of a result is produced (``noop`` sink). Keys given as arguments restrict the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from rivulet.plans.registry import QUERIES
from rivulet.runtime import local_session

WARM_UP = "edge_vertices"


def seconds(spark, sf_dir: str, key: str) -> float:
    begun = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begun, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "12g"))
    seconds(spark, sf_dir, WARM_UP)
    timed = {}
    for key in sys.argv[1:] or QUERIES:
        timed[key] = seconds(spark, sf_dir, key)
        print(f"{key} {timed[key]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
