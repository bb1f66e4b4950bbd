"""Time the headline queries; prints one JSON line.

Every query is run to the end (all rows, all columns, into a sink that keeps
nothing).  The value is the sum over queries of the best of ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import time

from checks.catalog import QUERIES
from triptych.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = get_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: min(run(spark, name) for _ in range(RUNS)) for name in QUERIES}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of best query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
