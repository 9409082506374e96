"""Headline timings as one JSON line.

Builds both warehouses (one ride per event, one per order line) and runs the
daily view and the thirteen marts on each: median of three runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from checks.queries import _marts, _variants, build_from, raw_tables
from fleetmart.operators.scale import remove_scratch, scratch_dir
from fleetmart.plans import warehouse

RUNS = 3


def _timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for rides, prefix in (("events", ""), ("orders", "orders_")):
        root = f"{scratch_dir(spark)}/bench-{rides}"
        build = lambda: build_from(raw_tables(spark, sf_dir, rides), root, rides)  # noqa: B023, E731
        build()
        seconds[f"{prefix}build"] = statistics.median(_timed(build) for _ in range(RUNS))
        if rides == "events":
            report = lambda: _run(warehouse.load_report(raw_tables(spark, sf_dir, rides)))  # noqa: B023, E731
            report()
            seconds["load_report"] = statistics.median(_timed(report) for _ in range(RUNS))
        queries = _marts(rides) | (_variants() if rides == "events" else {})
        for name, query in queries.items():
            run = partial(lambda query: _run(query(spark, sf_dir)), query)
            run()
            seconds[prefix + name] = statistics.median(_timed(run) for _ in range(RUNS))
    seconds = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "warehouse builds and marts, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
