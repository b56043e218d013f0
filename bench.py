"""Benchmark: headline queries, the whole job and its validation run on one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. Each query is timed from building its DataFrame to
the end of a ``noop`` write, so planning and every task are included and
nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockledger.config import ADAPTER_PERIOD, build_session  # noqa: E402
from stockledger.plans.catalog import queries  # noqa: E402
from stockledger.plans.job import run_checks, run_job  # noqa: E402
from stockledger.sources.adapter import driver_tables  # noqa: E402

HEADLINE = (
    "interval_stock",
    "daily_stock",
    "stock_as_of",
    "store_benefits",
    "family_benefits",
    "store_rotation",
    "family_rotation",
    "store_benefits_v2",
    "family_benefits_v2",
    "unpriced_total",
    "check_interval_balance",
    "check_daily_expansion",
    "check_contract",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="stockledger-bench-")
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        },
    )
    qs = queries()
    # warm-up: JVM, file listing, codegen caches (not timed)
    qs["store_universe"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    tables = driver_tables(spark, sf_dir)
    out = os.path.join(scratch, "out")
    t0 = time.perf_counter()
    run_job(tables, out, ADAPTER_PERIOD)
    times["full_job"] = round(time.perf_counter() - t0, 3)

    # the validation notebook's counterpart: every check over the published folder
    t0 = time.perf_counter()
    run_checks(tables, out, ADAPTER_PERIOD).write.format("noop").mode("overwrite").save()
    times["full_checks"] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_plus_full_job_and_checks",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
