"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gridloom.plans.catalog import QUERIES  # noqa: E402
from gridloom.session import get_session  # noqa: E402

HEADLINE = (
    "stage_readings",
    "fact_consumption",
    "upsert_readings",
    "scd2_merge",
    "daily_customer_summary",
    "regional_rollup",
    "dq_outliers",
    "fact_upsert",
    "dim_meter_fk",
)
RUNS = 3


def timed(spark, name: str, sf_dir: str) -> float:
    """Seconds from building the plan to the last row, without writing anything."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="7g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)  # warm-up
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    result = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps({**result, "sf": float(Path(sf_dir).name.removeprefix("sf"))}))


if __name__ == "__main__":
    main()
