"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma separated) override the defaults.
"""

from __future__ import annotations

import json
import os
import re
import time

from shelfcast.plans.queries import PLANS, run
from shelfcast.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(PLANS)
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run("dim_customer", spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        run(name, spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
